"""Column builders and distributed helpers shared by the operators."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word: a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a membership bitmap: 2^24 bits are 2 MiB in 512 rows, whatever the data.
BITMAP_BITS = 24
#: Rows that one (group, bucket) window of :func:`running` is aimed at.
BUCKET_ROWS = 20_000
MIN_BUCKETS = 64
MAX_BUCKETS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows that a Python task is sent at once, for the jobs run inside: for
    functions that need much memory per row."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct named ``__row``: an operator that returns the
    rows as they came carries them so, clear of its own column names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")


def ascii_lower(c: Column) -> Column:
    """A-Z only; every other letter keeps its case."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def word_count(c: Column) -> Column:
    """Number of words; NULL counts 0."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def group_key(c: Column) -> Column:
    """A never-NULL text key that tells NULL from every value."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))


def bitmap(keys: DataFrame, hash_col: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Membership bitmap of the 64-bit hashes in ``hash_col``: rows
    ``(__bucket, __bits)``, at most 2^bits / 32768 of 4 KiB, so that it may be
    broadcast whatever the number of keys.  More keys only mean more false
    positives."""
    pos = F.pmod(F.col(hash_col), F.lit(1 << bits)) + 1
    return (keys.select(F.bitmap_bucket_number(pos).alias("__bucket"), F.bitmap_bit_position(pos).alias("__pos"))
            .distinct()
            .groupBy("__bucket").agg(F.bitmap_construct_agg("__pos").alias("__bits")))


def with_membership(df: DataFrame, bm: DataFrame, hash_col: str, out: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Flag rows whose hash may be in the bitmap: true for every member,
    false for most others."""
    pos = F.pmod(F.col(hash_col), F.lit(1 << bits)) + 1
    bit = F.bitmap_bit_position(pos)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.col("__bits").isNotNull() & (F.expr("shiftright(__byte, __shift)").bitwiseAND(1) == 1)
    return (df.withColumn("__bucket", F.bitmap_bucket_number(pos))
            .join(F.broadcast(bm), "__bucket", "left")
            .withColumn("__byte", byte).withColumn("__shift", (bit % 8).cast("int"))
            .withColumn(out, F.coalesce(hit, F.lit(False)))
            .drop("__bucket", "__bits", "__byte", "__shift"))


def bucket_count(rows: int) -> int:
    """Buckets for :func:`running`: in proportion to the rows."""
    return max(MIN_BUCKETS, min(MAX_BUCKETS, -(-rows // BUCKET_ROWS)))


def running(df: DataFrame, group: list[str], bucket: str, order: list, weight: Column, out: str,
            extra: DataFrame | None = None) -> DataFrame:
    """Exclusive running total of ``weight`` in each group, in the order
    ``(bucket, *order)``, without ever sorting a group in one task: totals of
    the buckets are accumulated first (one row per bucket), then the rows
    inside each (group, bucket).  ``bucket`` must rise with the order.
    ``extra`` is a table keyed by ``group`` that travels with the totals.
    The group columns must not be NULL."""
    sums = df.groupBy(*group, bucket).agg(F.sum(weight).alias("__in_bucket"))
    before = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy(bucket)
    sums = sums.withColumn("__offset", F.coalesce(
        F.sum("__in_bucket").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__in_bucket")
    if extra is not None:
        sums = sums.join(extra, group, "left")
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(sums, [*group, bucket])
            .withColumn(out, F.col("__offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .drop("__offset"))
