"""Equi-joins with data-frame-library semantics.

* NULL keys match NULL keys (``<=>``); Catalyst still plans these as hash or
  sort-merge equi-joins (keys become ``coalesce(k, default), isnull(k)``).
* Join keys appear once in the output; for full joins they are coalesced.
* Non-key columns present on both sides get suffixes (``_x`` / ``_y``).
* Many-to-many matches multiply rows, as in the source.

No join here forces a strategy: the planner (and AQE at run time, from
measured shuffle sizes) decides between broadcast and sort-merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TMP = "__rk_"


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_ns(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join ``left`` and ``right`` on same-named ``on`` columns, NULL-safe.

    ``how`` is one of ``left``, ``inner``, ``full``, ``left_semi``,
    ``left_anti``.
    """
    keys = _keys(on)
    lcols, rcols = left.columns, right.columns
    for k in keys:
        if k not in lcols or k not in rcols:
            raise ValueError(f"join key {k!r} missing on one side")
    semi = how in ("left_semi", "semi", "left_anti", "anti")
    rnon = [c for c in rcols if c not in keys]
    clash = set() if semi else (set(lcols) - set(keys)) & set(rnon)
    if clash:
        left = left.select([F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in lcols])
    rk = {k: f"{_TMP}{i}" for i, k in enumerate(keys)}
    rsel = [F.col(k).alias(rk[k]) for k in keys]
    if not semi:
        rsel += [F.col(c).alias(c + suffixes[1] if c in clash else c) for c in rnon]
    right = right.select(rsel)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(rk[k])) for k in keys])
    how_spark = {"full": "full_outer", "outer": "full_outer", "semi": "left_semi", "anti": "left_anti"}.get(how, how)
    joined = left.join(right, cond, how_spark)
    if semi:
        return joined
    out_left = left.columns
    if how_spark == "full_outer":
        sel = [F.coalesce(F.col(c), F.col(rk[c])).alias(c) if c in rk else F.col(c) for c in out_left]
    else:
        sel = [F.col(c) for c in out_left]
    sel += [F.col(c + suffixes[1] if c in clash else c) for c in rnon]
    return joined.select(sel)


def left_join_ns(left: DataFrame, right: DataFrame, on, suffixes=("_x", "_y")) -> DataFrame:
    return join_ns(left, right, on, "left", suffixes)


def full_join_ns(left: DataFrame, right: DataFrame, on, suffixes=("_x", "_y")) -> DataFrame:
    return join_ns(left, right, on, "full", suffixes)


def semi_join_ns(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` whose key is in ``right`` (``%in%``); ``right`` may
    hold duplicates, ``left`` rows are never multiplied."""
    return join_ns(left, right, on, "left_semi")


def anti_join_ns(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    return join_ns(left, right, on, "left_anti")


def spread_attribute(df: DataFrame, keys: Sequence[str], attr: str) -> DataFrame:
    """Re-attach every distinct non-NULL ``attr`` of a key group to all rows
    of that group: a row is repeated once per distinct value, and rows of a
    group without values keep one row with NULL.

    Written as distinct + left join (not ``collect_set`` over a window) so a
    group's values are never gathered into one array, and AQE can split a
    skewed key.
    """
    keys = list(keys)
    values = df.select(*keys, attr).dropna(subset=[attr]).distinct()
    return left_join_ns(df.drop(attr), values, keys)
