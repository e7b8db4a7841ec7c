"""The latest period of a written table, from the statistics of its files.

The maximum of a text column is not pushed into a Parquet scan: file footers may
cut long texts short.  A table written by :func:`stage_ordered` has a
whole number beside the column that sorts like it, whose maximum Spark takes from
the footers alone (aggregate push-down), whatever the number of rows.  The rows
of the latest period are then those with that number, a literal filter, which
skips row groups, as each task writes its rows in the number's order.

The number holds the first seven bytes of the text and its length up to eight,
so texts of seven bytes or less (``FY24Q1`` has six) have one of their own.
Longer ones that begin alike share one; their maximum is taken among the rows of
that number only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.operators.aggs import latest_period
from fundflow.operators.stage import shared_dir
from fundflow.session import session_with

#: Bytes of the text that the number holds; with its length it is below 2^60.
BYTES = 7
_LENGTHS = 16
NULL_ORDER = -1


def order_name(col: str) -> str:
    return f"__order_{col}"


def order_number(col: str) -> Column:
    """Sorts like the text's bytes, equal only for equal texts or texts of
    more than seven bytes whose first seven are equal; -1 for NULL, below all."""
    raw = F.col(f"`{col}`").cast("string").cast("binary")
    head = F.rpad(F.substring(raw, 1, BYTES), BYTES, F.lit(b"\0"))
    number = F.conv(F.hex(head), 16, 10).cast("long") * _LENGTHS + F.least(F.octet_length(raw), F.lit(BYTES + 1))
    return F.coalesce(number, F.lit(NULL_ORDER).cast("long"))


@dataclass(frozen=True)
class OrderedTable:
    """A written table with the order number of ``col``."""

    spark: SparkSession
    path: str
    col: str

    @property
    def rows(self) -> DataFrame:
        """All rows, as they were before the write."""
        return self.spark.read.parquet(self.path).drop(order_name(self.col))

    def top(self) -> DataFrame:
        """One row, the largest order number, NULL without rows.  Made in a
        session of its own, as only the second version of the file source
        pushes aggregates down; settings of the caller's stay as they are."""
        own = session_with(self.spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"})
        name = order_name(self.col)
        return own.read.schema(f"`{name}` long").parquet(self.path).agg(F.max(name).alias("top"))

    def latest(self) -> DataFrame:
        """:func:`fundflow.operators.latest_period` of the rows.  No rows where
        the column is NULL throughout or the table is empty."""
        top = self.top().first()["top"]
        name = order_name(self.col)
        if top is None or top == NULL_ORDER:
            return self.rows.limit(0)
        found = self.spark.read.parquet(self.path).filter(F.col(name) == F.lit(top)).drop(name)
        return latest_period(found, self.col) if top % _LENGTHS > BYTES else found


def stage_ordered(df: DataFrame, name: str, col: str = "period") -> OrderedTable:
    """:func:`fundflow.operators.stage` for a table whose latest ``col`` is
    asked for later; rows are sorted inside a task, not exchanged.  The number
    is the first column: push-down finds a column's statistics in the footer by
    its place, which others of nested types before it would shift."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/fundflow-stage/{name}-{uuid.uuid4().hex}"
    order = order_name(col)
    numbered = df.select(order_number(col).alias(order), *[F.col(f"`{c}`") for c in df.columns])
    numbered.sortWithinPartitions(order).write.mode("error").parquet(path)
    return OrderedTable(spark, path, col)
