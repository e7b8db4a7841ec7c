"""Left joins in which a key holds a large part of all rows.

Adaptive execution splits a skewed partition only where both sides come
straight from a shuffle, and only once it has been written.  Here heavy keys
are known before the shuffle: a frequent-items sketch of the join key, of fixed
size, is taken in one pass over the left side.  A heavy key's left rows are
dealt over ``salts`` partitions by a hash of the row, and its right rows are
copied to each of them; all other keys have one salt, and no right row more.
The rows are those of the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.operators.joins import left_join_ns

#: Items the sketch tracks: it errs by less than a thousandth of the rows.
TRACKED = 4096
#: Heavy keys that are named to the plan at most, whatever the data.
MOST = 64
#: Share of all rows that makes a key heavy.
SHARE = 0.02
SALTS = 32
_SALT = "__salt"


def _text(on: Sequence[str]) -> Column:
    """The key as one text that is never NULL; lengths keep columns apart."""
    each = [F.coalesce(F.concat(F.char_length(F.col(c).cast("string")).cast("string"), F.lit("="), F.col(c).cast("string")),
                       F.lit("~")) for c in on]
    return F.concat(*each)


def heavy_keys(df: DataFrame, on: Sequence[str], share: float = SHARE, most: int = MOST) -> list[str]:
    """Key texts that hold about ``share`` of the rows or more: one pass, a
    sketch of :data:`TRACKED` items a task, at most ``most`` keys returned."""
    r = (df.select(_text(on).alias("k"))
         .agg(F.expr(f"approx_top_k(k, {most}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first())
    return [x["item"] for x in r["top"] or () if x["count"] >= share * r["n"] and x["count"] > 1]


def left_join_hot(left: DataFrame, right: DataFrame, on: str | Sequence[str], suffixes: tuple[str, str] = ("_x", "_y"),
                  heavy: Sequence[str] | None = None, salts: int = SALTS) -> DataFrame:
    """:func:`fundflow.operators.left_join_ns` (NULL matches NULL) with heavy
    keys spread.  ``heavy`` are key texts from :func:`heavy_keys` of the left
    side, taken here unless given.  Left rows that are equal in all columns
    stay together."""
    on = [on] if isinstance(on, str) else list(on)
    heavy = heavy_keys(left, on) if heavy is None else list(heavy)
    if not heavy:
        return left_join_ns(left, right, on, suffixes)
    is_heavy = _text(on).isin(heavy)
    dealt = F.pmod(F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in left.columns]))), F.lit(salts)).cast("int")
    left = left.withColumn(_SALT, F.when(is_heavy, dealt).otherwise(F.lit(0)))
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn(_SALT, F.explode(copies))
    return left_join_ns(left, right, [*on, _SALT], suffixes).drop(_SALT)


def spread_attribute_hot(df: DataFrame, keys: Sequence[str], attr: str, salts: int = SALTS) -> DataFrame:
    """:func:`fundflow.operators.spread_attribute` for groups that may hold a
    large part of all rows."""
    keys = list(keys)
    values = df.select(*keys, attr).dropna(subset=[attr]).distinct()
    return left_join_hot(df.drop(attr), values, keys, salts=salts)
