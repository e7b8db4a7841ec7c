"""A membership filter of fixed size: rows that cannot have a partner are
dropped before they are shuffled to a join.

The filter is a bitmap over a hash of the key, cut into rows of 4 KiB.  Its
size depends on ``bits`` alone, never on the keys, so broadcasting it is safe
whatever the size of the key set; more keys only let more rows through.  It
never drops a member, so a join behind it gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^24 bits: 512 rows, 2 MiB.
BITS = 24
#: Bound of a filter sized for a measured key set: 2^27 bits, 16 MiB.
MAX_BITS = 27


def bits_for(rows: int | None) -> int:
    """Bits for about eight a key, between the two bounds; unknown sizes get the smaller."""
    return BITS if rows is None else max(BITS, min(MAX_BITS, (8 * rows).bit_length()))


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("member"), key), F.lit(1 << bits)) + 1


def member_filter(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The filter of a column's non-NULL values: ``__part, __map``, at most
    2^bits / 32768 rows.  Positions are made distinct before the shuffle."""
    at = keys.filter(F.col(key).isNotNull()).select(_place(F.col(key), bits).alias("at")).distinct()
    return (at.groupBy(F.bitmap_bucket_number("at").alias("__part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__map")))


def maybe_members(df: DataFrame, key: str, members: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows whose ``key`` may be a member; NULL is none."""
    at = F.bitmap_bit_position(F.col("__at"))
    byte = F.conv(F.hex(F.substring("__map", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (at % 8).cast("int")) == 1
    return (df.filter(F.col(key).isNotNull()).withColumn("__at", _place(F.col(key), bits))
            .withColumn("__part", F.bitmap_bucket_number("__at"))
            .join(F.broadcast(members), "__part").filter(is_set).select(*df.columns))
