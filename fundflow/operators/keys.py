"""Award key sets and key resolution, kept distributed.

The source pulls key vectors to the client and tests membership with
``%in%``.  Here a key set is a one-column distinct DataFrame and membership
is a join, so nothing is collected and the set may be any size.  A key set
measured with :func:`fundflow.operators.stage.measure_keys` is broadcast
when its bound fits the broadcast limit; any other key set is met in a
shuffle join, salted where one key may be hot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.operators.joins import semi_join_ns
from fundflow.operators.membership import bits_for, maybe_members, member_filter
from fundflow.operators.stage import KeySet

KEY = "award_number"
# Partitions over which one key's candidate rows are spread; the key set is read this many times over.
SALT_BUCKETS = 16


def keys_df(keys: DataFrame | KeySet) -> DataFrame:
    return keys.df if isinstance(keys, KeySet) else keys


def can_broadcast(keys: DataFrame | KeySet) -> bool:
    """Only a measured key set within the broadcast limit is broadcast;
    an unmeasured one is left to the planner and AQE."""
    return isinstance(keys, KeySet) and keys.broadcastable()


def key_set(df: DataFrame, col: str = KEY) -> DataFrame:
    """Distinct non-NULL values of ``col`` as a one-column DataFrame named
    ``award_number``."""
    return df.select(F.col(col).alias(KEY)).dropna().distinct()


def union_keys(*sets: DataFrame) -> DataFrame:
    """Union of key sets, de-duplicated (a key both active and expired
    must appear once, or flag joins would double rows)."""
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    return out.distinct()


def in_keys(df: DataFrame, keys: DataFrame | KeySet, col: str = KEY) -> DataFrame:
    """Rows of ``df`` whose ``col`` is in ``keys``."""
    k = keys_df(keys)
    k = k.select(F.col(KEY).alias(col)) if col != KEY else k
    if can_broadcast(keys):
        k = F.broadcast(k)
    return semi_join_ns(df, k, col)


def resolve_key(
    df: DataFrame,
    keys: DataFrame | KeySet,
    candidates: Sequence[str],
    out: str = KEY,
    keep_unmatched: bool = False,
    cut: Callable[[DataFrame], DataFrame] | None = None,
    always: Column | None = None,
    written: bool = False,
) -> DataFrame:
    """Pick, per row, the first of ``candidates`` that is a member of
    ``keys`` and write it to ``out``.

    The source writes ``case_when(a %in% K ~ a, b %in% K ~ b, TRUE ~ c)``
    followed by ``filter(out %in% K)``: a row survives iff some candidate
    is a member, and the chosen value is the first member.  With
    ``keep_unmatched`` the other rows keep the last candidate; rows for which
    ``always`` is true stay with a NULL key.

    A measured key set within the broadcast limit is broadcast: one left
    join per candidate adds a membership flag, all map-side in one stage.

    Any other key set is met once: the distinct candidate tuples are
    exploded into (tuple, rank, candidate), joined to the key set, and the
    least rank per tuple is joined back.  A hot key's candidates are spread
    over ``SALT_BUCKETS`` partitions by a hash of their tuple, against as many
    copies of the key set.  Callers should pre-aggregate ``df`` on the
    candidate columns first (see :func:`fundflow.plans.feeds.transactions`).

    ``df`` is needed twice there, for its tuples and for the join back.
    ``cut`` writes it and reads it back (:func:`fundflow.operators.stage`), so
    that what it comes from is scanned and shuffled once.  Candidates then
    pass a membership filter of the key set before they are shuffled, and the
    chosen keys are written too: the join back has two plain tables, of which
    adaptive execution splits the rows of a hot tuple.  A ``df`` that is
    ``written`` already, a scan of files, is not written once more.
    """
    if not can_broadcast(keys):
        return _resolve_large(df, keys, list(candidates), out, keep_unmatched, cut, always, written)
    # NULL is never a key (key sets are built from non-NULL values), so a
    # NULL candidate is simply "not a member"; plain equality then gives the
    # same result as a NULL-safe test.
    kdf = keys_df(keys).dropna()
    flags = []
    for i, c in enumerate(candidates):
        kcol, fcol = f"__key{i}", f"__hit{i}"
        right = kdf.select(F.col(KEY).alias(kcol)).withColumn(fcol, F.lit(True))
        df = df.join(F.broadcast(right), F.col(c) == F.col(kcol), "left").drop(kcol)
        flags.append(fcol)
    chosen = None
    for c, f in zip(candidates, flags):
        chosen = F.when(F.col(f), F.col(c)) if chosen is None else chosen.when(F.col(f), F.col(c))
    if keep_unmatched:
        chosen = chosen.otherwise(F.col(candidates[-1]))
        hit = F.lit(True)
    else:
        hit = F.coalesce(*[F.col(f) for f in flags], F.lit(False))
        hit = hit if always is None else hit | always
    return df.filter(hit).withColumn(out, chosen).drop(*flags)


def _resolve_large(df: DataFrame, keys: DataFrame | KeySet, candidates: list[str], out: str, keep_unmatched: bool,
                   cut: Callable[[DataFrame], DataFrame] | None, always: Column | None, written: bool) -> DataFrame:
    """:func:`resolve_key` by one salted shuffle join, for key sets of any size."""
    bits = bits_for(keys.rows if isinstance(keys, KeySet) else None)
    keys = keys_df(keys)
    if cut is not None and not written:
        df = cut(df)
    tup = [f"__t{i}" for i in range(len(candidates))]
    tuples = df.select([F.col(c).alias(t) for c, t in zip(candidates, tup)]).distinct()
    ranked = (tuples.select(*tup, F.posexplode(F.array(*tup)).alias("__rank", KEY)).dropna(subset=[KEY])
              .withColumn("__salt", F.pmod(F.xxhash64(*tup), F.lit(SALT_BUCKETS)).cast("int")))
    if cut is not None:
        ranked = maybe_members(ranked, KEY, member_filter(keys, KEY, bits), bits)
    salted = (keys.select(KEY).dropna().distinct()
              .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT_BUCKETS - 1)))))
    # The planner takes the copies for one key set and may broadcast them, 16 times larger, to every task.
    rank = ranked.join(salted.hint("merge"), [KEY, "__salt"]).groupBy(*tup).agg(F.min("__rank").alias("__rank"))
    first = rank.select(*tup, F.coalesce(*[F.when(F.col("__rank") == i, F.col(t)) for i, t in enumerate(tup)]).alias("__chosen"))
    if cut is not None:
        first = cut(first)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(t)) for c, t in zip(candidates, tup)])
    got = df.join(first, same, "left" if keep_unmatched or always is not None else "inner")
    if always is not None and not keep_unmatched:
        got = got.filter(F.col("__chosen").isNotNull() | always)
    chosen = F.coalesce("__chosen", candidates[-1]) if keep_unmatched else F.col("__chosen")
    return got.withColumn(out, chosen).drop("__chosen", *tup)
