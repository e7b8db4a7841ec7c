"""Mixing sources to target weights as a time-varying curriculum (native).

Each source has a weight schedule over training time 0..1, a piecewise linear
function given by knots.  Its integral says how much of the source's target
has been demanded by any time; inverting it turns a document's place in the
source's seeded order into the training time at which the document is due.
Sorting all copies by that time gives the training order.

The words a source provides run through its documents again and again (at
most ``MAX_EPOCHS`` times); copy k of a document that starts at running total
c covers words ``k * source_size + c`` onward, and is taken as far as the
target reaches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundflow.llm.common import (MIN_BUCKETS, bitmap, bucket_count, group_key, running, whole_row, with_membership,
                                 word_count)
from fundflow.operators.stage import stage

MAX_EPOCHS = 3
SEED = "mix-1"
#: Weights by the source's rank, repeating, and the factors of a source's weight at the start and at the end of
#: training: heavy sources lead, light ones follow.  The factors average 1, so the integral is the weight.
WEIGHTS = (5, 2, 1)
TILT = ((1.4, 0.6), (1.0, 1.0), (0.6, 1.4))


def ranked_weights(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   tilt: Sequence[tuple[float, float]] = TILT) -> DataFrame:
    """Add ``weight`` and ``knots`` to a table with one row per source, by the
    rank of the source's name in code-point order, NULL last.  The table has
    one row per source; it is the only thing sorted as a whole."""
    rank = (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1)
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("__rank") % len(xs)).cast("int") + 1)
    knot = lambda t, f: F.struct(F.lit(t).alias("t"), (F.col("weight") * f).alias("w"))
    return (sizes.withColumn("__rank", rank).withColumn("weight", pick(weights).cast("double"))
            .withColumn("knots", F.array(knot(0.0, pick([a for a, _ in tilt])), knot(1.0, pick([b for _, b in tilt]))))
            .drop("__rank"))


def water_fill(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to ``(source_size, weight, ...)``: the total of all sizes
    shared by weight, no source above ``max_epochs`` times its size, the
    excess reshared by weight until none is above.

    Sources are capped in the order of cap / weight; before each, the level is
    what the capped ones leave over the weights of the rest.  The first source
    whose cap is not below its share at that level fixes the level for all
    that follow."""
    cap = F.col("source_size") * float(max_epochs)
    w = Window.partitionBy(F.lit(0))
    order = w.orderBy(F.col("__ratio").asc_nulls_last(), F.col("__gk"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = ((F.sum("source_size").over(w) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
             / F.nullif(rest, F.lit(0.0)))
    return (sizes.withColumn("__cap", cap).withColumn("__ratio", F.col("__cap") / F.nullif(F.col("weight"), F.lit(0.0)))
            .withColumn("__level", level).withColumn("__i", F.row_number().over(order))
            .withColumn("__first", F.min(F.when(F.col("__cap") >= F.col("weight") * F.col("__level"), F.col("__i")))
                        .over(w))
            .withColumn("__lambda", F.max(F.when(F.col("__i") == F.col("__first"), F.col("__level"))).over(w))
            .withColumn("target", F.when(F.col("__i") < F.coalesce(F.col("__first"), F.lit(1 << 62)), F.col("__cap"))
                        .otherwise(F.col("weight") * F.col("__lambda")))
            .drop("__cap", "__ratio", "__level", "__i", "__first", "__lambda"))


def segments(knots: Column) -> Column:
    """Knots ``array<struct<t, w>>``, ``t`` rising, to segments with start ``t0``, length
    ``d``, weight ``a`` at the start, slope ``b`` and integral ``s0`` before."""
    pair = F.transform(F.sequence(F.lit(0), F.size(knots) - 2), lambda i: F.struct(
        F.get(knots, i)["t"].alias("t0"), (F.get(knots, i + 1)["t"] - F.get(knots, i)["t"]).alias("d"),
        F.get(knots, i)["w"].alias("a"),
        ((F.get(knots, i + 1)["w"] - F.get(knots, i)["w"]) / (F.get(knots, i + 1)["t"] - F.get(knots, i)["t"]))
        .alias("b")))
    area = lambda s: s["d"] * (s["a"] + s["b"] * s["d"] / 2.0)
    return F.transform(pair, lambda s, i: F.struct(
        s["t0"].alias("t0"), s["d"].alias("d"), s["a"].alias("a"), s["b"].alias("b"),
        F.aggregate(F.slice(pair, 1, i), F.lit(0.0), lambda acc, x: acc + area(x)).alias("s0"),
        area(s).alias("area")))


def time_of(segs: Column, share: Column) -> Column:
    """Training time at which ``share`` (0..1) of the schedule's integral is
    reached: the inverse of a piecewise quadratic."""
    whole = F.aggregate(segs, F.lit(0.0), lambda acc, s: acc + s["area"])
    due = share * whole
    s = F.coalesce(F.try_element_at(F.filter(segs, lambda s: (s["s0"] <= due) & (s["area"] > 0)), F.lit(-1)), F.get(segs, 0))
    rest = F.greatest(due - s["s0"], F.lit(0.0))
    root = s["a"] + F.sqrt(F.greatest(s["a"] * s["a"] + 2.0 * s["b"] * rest, F.lit(0.0)))
    return s["t0"] + F.least(F.when(root > 0, 2.0 * rest / root).otherwise(F.lit(0.0)), s["d"])


def mix_plan(docs: DataFrame, weigh=ranked_weights, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", seed: str = SEED, max_epochs: int = MAX_EPOCHS,
             whole: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target,
    taken, copies, __text_md5``, where ``copies`` lists ``(copy, take,
    position)`` of every copy the mix takes.

    ``weigh`` adds ``weight`` and ``knots`` to a table ``(source, source_size)``.
    With ``whole`` a source's last copy is taken whole when at least half of
    it is due, else left; otherwise the words due are taken of it, and the
    source meets its target to the word.

    A NULL source is a source of its own, a NULL or empty text has size 0 and
    is never taken, an empty table gives no rows.  Rows are ordered by a
    seeded digest of id and text: rows that repeat both are interchangeable.
    """
    md5 = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("__text_md5"))
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size"), md5.alias("__text_md5"))
            .withColumn("__gk", group_key(F.col("source"))).withColumn("__h", F.md5(key.cast("binary"))))
    rows = stage(rows, "mix-rows")
    n = bucket_count(rows.count())
    rows = rows.withColumn("__b", F.shiftright(F.conv(F.substring("__h", 1, 4), 16, 10).cast("long") * n, 16))
    sizes = rows.groupBy("__gk").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = water_fill(weigh(sizes), max_epochs).withColumn("__segs", segments(F.col("knots")))
    plan = stage(plan.select("__gk", "source_size", "target", "__segs"), "mix-plan")
    rows = running(rows, ["__gk"], "__b", ["__h"], F.col("size"), "__c", plan)
    due = F.floor(F.col("target") + 0.5).cast("long")
    start = lambda k: F.col("__c") + F.col("source_size") * k
    if whole:
        take = lambda k: F.when(start(k) * 2 + F.col("size") <= due * 2, F.col("size")).otherwise(F.lit(0))
    else:
        take = lambda k: F.greatest(F.least(due - start(k), F.col("size")), F.lit(0))
    copies = F.filter(F.transform(F.array(*[F.lit(k) for k in range(max_epochs)]), lambda k: F.struct(
        k.alias("copy"), take(k).cast("long").alias("take"),
        F.least(time_of(F.col("__segs"), start(k) / F.nullif(F.col("target"), F.lit(0.0))), F.lit(1.0)).alias("position"))),
        lambda x: x["take"] > 0)
    return (rows.withColumn("copies", copies)
            .withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda acc, x: acc + x["take"]))
            .select("doc_id", "source", "size", "source_size", "target", "taken", "copies", "__text_md5"))


def numbered(rows: DataFrame, repeated: DataFrame, key: list[str], spread: Column, order: list) -> DataFrame:
    """``rows`` with ``__copy``: 0 but for the rows whose key is in
    ``repeated``, which are numbered from 0 in buckets of ``spread``."""
    h = F.xxhash64(*key)
    flagged = with_membership(rows.withColumn("__h", h), bitmap(repeated.select(h.alias("__h")), "__h"), "__h", "__in")
    again = flagged.filter("__in").withColumn("__b", F.pmod(spread, F.lit(MIN_BUCKETS)).cast("int"))
    again = running(again, key, "__b", order, F.lit(1), "__copy").withColumn("__copy", F.col("__copy").cast("long"))
    return (flagged.filter("NOT __in").select(*rows.columns, F.lit(0).cast("long").alias("__copy"))
            .unionByName(again.select(*rows.columns, "__copy")))


def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **kw) -> DataFrame:
    """The mixed documents in training order: all columns of ``docs``, one row
    per copy the mix takes, range-sorted by training time.  Copies are whole
    documents.  Documents the mix does not take are left out.

    Rows that repeat id, text and source are numbered, and each takes the
    copies of one place in the mix; rows equal in all columns are
    interchangeable.  NULL ids and sources are values like any other."""
    plan = mix_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, whole=True, **kw)
    key = ["__id", "__text_md5", "__src"]
    plan = stage(plan.select(group_key(F.col("doc_id")).alias("__id"), "__text_md5", group_key(F.col("source")).alias("__src"),
                             F.col("copies.position").alias("__at")), "mix-copies")
    repeated = stage(plan.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n"), "mix-repeated")
    taken = plan.filter("size(__at) > 0")
    md5 = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    rows = docs.select(whole_row(docs), group_key(F.col(id_col)).alias("__id"), md5.alias("__text_md5"),
                       group_key(F.col(source_col)).alias("__src"))
    if repeated.isEmpty():
        due = rows.join(taken, key)
    else:
        taken = numbered(taken, repeated, key, F.xxhash64("__at"), [F.col("__at")])
        # All columns make up the order, as text: maps have none.
        whole = F.xxhash64(F.to_json("__row"))
        due = numbered(rows, repeated, key, whole, [whole]).join(taken, [*key, "__copy"])
    return (due.withColumn("__at", F.explode("__at"))
            .repartitionByRange(F.col("__at"), F.col("__id")).sortWithinPartitions("__at", "__id", "__text_md5")
            .select("__row.*"))
