"""Tables laid out by a key, so that joins on it need no exchange.

A table that several joins meet on the same key is written once as a bucketed
Parquet table in the shared folder: rows of one key lie in one bucket, and
every join of two such tables on that key, or on it and more columns, reads
bucket by bucket without a shuffle.

Keys match NULL to NULL.  A NULL-safe comparison hides the columns from the
planner, so each key is written beside itself as text that is never NULL, and
joins compare that with plain equality.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.operators.stage import shared_dir

#: Lets a join on more columns than the buckets' use them.
SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def key_name(col: str) -> str:
    return f"__key_{col}"


def key_text(col: str) -> Column:
    """Never NULL, and different for NULL and every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), key_text_of_null())


def key_text_of_null() -> Column:
    return F.lit("~")


def lay_out(df: DataFrame, name: str, keys: Sequence[str], more: Sequence[str] = (), buckets: int | None = None,
            keep: bool = True) -> DataFrame:
    """Write ``df`` in buckets of ``keys`` and return it read back, with the
    key texts of ``keys`` and ``more`` (instead of them, unless ``keep``); one
    exchange, before the write.
    ``buckets`` is the session's number of shuffle partitions unless given;
    tables that are to be joined need the same."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(SUBSET_KEYS, "false")
    by = [key_name(k) for k in keys]
    df = df.withColumns({key_name(k): key_text(k) for k in (*keys, *more)})
    df = df if keep else df.drop(*keys, *more)
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(n, *by).write.bucketBy(n, *by).sortBy(*by).format("parquet")
     .option("path", f"{shared_dir(spark)}/fundflow-stage/{table}").saveAsTable(table))
    return spark.table(table)


def drop_key_texts(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__key_")])


def left_join_laid_out(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """:func:`fundflow.operators.left_join_ns` (or a semi join) of tables from
    :func:`lay_out`, which must have key texts for all of ``on`` and share no
    other columns."""
    texts = [key_name(c) for c in on]
    drop = [*on, *[c for c in right.columns if c.startswith("__key_") and c not in texts]]
    clash = (set(left.columns) & set(right.columns)) - set(texts) - set(drop)
    if clash and how == "left":
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")
    return left.join(right.drop(*drop), texts, how)
