"""Coverage and reconciliation checks.

Each returns a DataFrame for a person to read (nothing asserts), exactly
like the source's written check tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundflow.config import DEFAULT, EXISTS_MARK, YES_MARK, FlowConfig
from fundflow.operators import (
    anti_join_ns,
    full_join_ns,
    in_keys,
    left_join_ns,
    lenient_sum,
    semi_join_ns,
)

from fundflow.operators.layout import key_text, key_text_of_null

AP = ["award_number", "period"]
AREA_PERIOD = ["program_area", "period"]


def _first(df: DataFrame, cols) -> DataFrame:
    """Move ``cols`` to the front, keep the rest in order."""
    return df.select(*cols, *[c for c in df.columns if c not in cols])


def _marks(df: DataFrame, keys, name: str, mark: str) -> DataFrame:
    return df.select(*keys).distinct().withColumn(name, F.lit(mark))


def coverage_awards(active: DataFrame, plan: DataFrame, ledger: DataFrame, txn: DataFrame) -> DataFrame:
    """K1: per active (activity, award, period), "exists" where the plan,
    the ledger and the transactions have that award-period."""
    out = active.select("activity_name", "award_number", "period").distinct()
    out = left_join_ns(out, _marks(plan, AP, "subobligation_summary", EXISTS_MARK), AP)
    out = left_join_ns(out, _marks(ledger, AP, "pipeline", EXISTS_MARK), AP)
    return left_join_ns(out, _marks(txn, AP, "transaction", EXISTS_MARK), AP)


def coverage_areas(active: DataFrame, plan: DataFrame, txn: DataFrame, ledger: DataFrame,
                   active_keys: DataFrame) -> DataFrame:
    """K2: per (area, period), "yes" where the plan (for active
    award-periods), the ledger and the transactions (active awards) have
    the area; sorted by period, area with NULLs last.

    The plan side is a semi join: in the source's left join, active rows
    without a plan match only contribute a NULL area, which is dropped.  The
    three inputs are one union with a bit each, and one aggregation ORs the
    bits of an (area, period) before and after its shuffle: what the source's
    two full joins and its distinct give.
    """
    in_plan = semi_join_ns(plan, active.select(*AP), AP).filter(F.col("program_area").isNotNull())
    inputs = {"subobligation": in_plan, "pipeline": in_keys(ledger, active_keys), "transaction": in_keys(txn, active_keys)}
    bits = [df.select(*AREA_PERIOD, F.lit(1 << i).alias("__bit")) for i, df in enumerate(inputs.values())]
    seen = bits[0].unionByName(bits[1]).unionByName(bits[2]).groupBy(*AREA_PERIOD).agg(F.bit_or("__bit").alias("__bits"))
    marks = [F.when(F.col("__bits").bitwiseAND(1 << i) != 0, F.lit(YES_MARK)).alias(name) for i, name in enumerate(inputs)]
    return (seen.select(*AREA_PERIOD, *marks)
            .orderBy(F.col("period").asc_nulls_last(), F.col("program_area").asc_nulls_last()))


def missing_area(active: DataFrame, plan: DataFrame) -> DataFrame:
    """K3: named active award-periods that have no mapped plan area."""
    named = active.filter(F.col("activity_name").isNotNull()).select("award_number", "period", "activity_name").distinct()
    areas = plan.select("award_number", "period", "program_area").distinct()
    return left_join_ns(named, areas, AP).filter(F.col("program_area").isNull())


def area_spotlight(active: DataFrame, ledger: DataFrame, txn: DataFrame, active_keys: DataFrame,
                   cfg: FlowConfig = DEFAULT) -> DataFrame:
    """K4: ledger FULL JOIN transactions on (award, period) for one program
    area and active awards, with the activity name attached."""
    area = F.col("program_area") == F.lit(cfg.spotlight_area)
    p = in_keys(ledger, active_keys).filter(area)
    t = in_keys(txn, active_keys).filter(area)
    awards = active.select("award_number", "activity_name", "period")
    df = left_join_ns(full_join_ns(p, t, AP), awards, AP)
    return _first(df, ["award_number", "activity_name", "period"])


def recon_awards(active: DataFrame, pipeline: DataFrame) -> DataFrame:
    """K5: raw vs reported estimated cost per award-period."""
    raw = (active.select("award_number", "activity_name", "period", "total_estimated_cost")
           .withColumn("raw_total_estimated_cost", F.col("total_estimated_cost")))
    new = (pipeline.select("award_number", "period", "total_estimated_cost").distinct()
           .withColumnRenamed("total_estimated_cost", "new_total_estimated_cost"))
    df = left_join_ns(raw, new, AP)
    df = df.withColumn("TEA_diff", F.col("raw_total_estimated_cost") - F.col("new_total_estimated_cost"))
    return df.drop("total_estimated_cost")


def _recon_txn(active: DataFrame, txn: DataFrame, reported: DataFrame) -> DataFrame:
    """Raw and reported rows in one union and one group-by: an award-period's
    raw and reported sums, and how many rows each side has.  Those with raw
    rows stay, as in the source's left join; its joins to the award's activity
    names repeat a row once per name on either side."""
    sides = [df.select(*AP, *[F.col("transaction_amt").alias(s) if s == side else F.lit(None).cast("double").alias(s)
                              for s in ("raw", "new")], F.lit(side).alias("side"))
             for df, side in ((txn, "raw"), (reported, "new"))]
    both = (sides[0].unionByName(sides[1]).groupBy(*AP)
            .agg(lenient_sum("raw").alias("raw_transaction_amt"), lenient_sum("new").alias("new_transaction_amt"),
                 F.count_if(F.col("side") == "raw").alias("raws"), F.count_if(F.col("side") == "new").alias("news"))
            .filter("raws > 0"))
    names = active.select("award_number", "activity_name").distinct().groupBy("award_number").agg(
        F.count(F.lit(1)).alias("names"))
    n = F.coalesce("names", F.lit(1).cast("long"))
    df = left_join_ns(both, names, "award_number").withColumn("times", F.when(F.col("news") > 0, n * n).otherwise(n))
    df = df.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return df.select(*AP, "raw_transaction_amt", "new_transaction_amt",
                     (F.col("raw_transaction_amt") - F.col("new_transaction_amt")).alias("transaction_diff"))


def recon_txn_pipeline(txn: DataFrame, active: DataFrame, pipeline: DataFrame) -> DataFrame:
    """K6: transaction amount per award-period, raw (D0) vs pipeline dataset."""
    return _recon_txn(active, txn, pipeline)


def recon_txn_dataset(active: DataFrame, txn: DataFrame, txn_dataset: DataFrame) -> DataFrame:
    """K7: transaction amount per award-period, raw (D0) vs transaction dataset."""
    return _recon_txn(active, txn, txn_dataset)


LEDGER_MEASURES = ("document_amt", "disbursement_amt", "last_qtr_accrual_amt", "undisbursed_amt")


def recon_ledger(ledger: DataFrame, active: DataFrame, pipeline: DataFrame) -> DataFrame:
    """K8: ledger amounts per award-period, raw vs pipeline dataset, with
    differences.

    Ledger, award list and pipeline are one union, summed once by award, period
    and activity (the ledger's rows under a mark of their own); a window over
    the few rows of an award-period then gives its raw sums to its activities.
    As in the source's left joins, award-periods with ledger rows stay, an
    activity is repeated once per estimated cost it is listed with, and an
    award-period without listed activities has one row without a name.
    """
    nothing = F.lit(None)
    raw, new = [f"raw_{m}" for m in LEDGER_MEASURES], [f"new_{m}" for m in LEDGER_MEASURES]

    def side(df: DataFrame, key, name, cost, amounts: Sequence[str], kind: str) -> DataFrame:
        value = lambda m, c: F.col(m).cast("double") if c in amounts else nothing.cast("double")
        return df.select(*AP, key.alias("key"), name.alias("activity_name"), cost.alias("cost"), F.lit(kind).alias("kind"),
                         *[value(m, c).alias(c) for cols in (raw, new) for m, c in zip(LEDGER_MEASURES, cols)])

    cost_type = active.schema["total_estimated_cost"].dataType
    no_name, no_cost = nothing.cast("string"), nothing.cast(f"struct<c:{cost_type.simpleString()}>")
    by_name = key_text("activity_name")
    rows = (side(ledger, F.lit(""), no_name, no_cost, raw, "ledger")
            .unionByName(side(active, by_name, F.col("activity_name"), F.struct(F.col("total_estimated_cost").alias("c")), (), "active"))
            .unionByName(side(pipeline, by_name, F.col("activity_name"), no_cost, new, "pipeline")))
    sums = rows.groupBy(*AP, "key").agg(
        F.max("activity_name").alias("activity_name"), F.size(F.collect_set("cost")).alias("costs"),
        F.count_if(F.col("kind") == "ledger").alias("lines"), *[lenient_sum(c) for c in (*raw, *new)])
    here = Window.partitionBy(*AP)
    unnamed = {c: F.coalesce(F.sum(F.when(F.col("key") == key_text_of_null(), F.col(c))).over(here), F.lit(0.0)) for c in new}
    listed = F.max("costs").over(here)
    sums = sums.withColumns({"listed": listed, "all_lines": F.sum("lines").over(here),
                             **{f"__{c}": F.sum(c).over(here) for c in raw}, **{f"__{c}": v for c, v in unnamed.items()}})
    kept = sums.filter((F.col("all_lines") > 0) & F.when(F.col("listed") > 0, F.col("costs") > 0).otherwise(F.col("key") == ""))
    kept = kept.withColumn("__i", F.explode(F.sequence(F.lit(1), F.greatest("costs", F.lit(1)))))
    out: list = ["award_number", "activity_name", "period"]
    for m, diff in zip(LEDGER_MEASURES, ("document_dif", "disbursement_dif", "last_qtr_accrual_diff", "undisbursed_diff")):
        r, n = F.col(f"__raw_{m}"), F.when(F.col("key") == "", F.col(f"__new_{m}")).otherwise(F.col(f"new_{m}"))
        out += [r.alias(f"raw_{m}"), n.alias(f"new_{m}"), (r - n).alias(diff)]
    return kept.select(*out)


def distinct_activities(active: DataFrame) -> DataFrame:
    """K9: distinct (award, activity) pairs of the active list."""
    return active.select("award_number", "activity_name").distinct()


def plan_awards_not_active(plan: DataFrame, active: DataFrame) -> DataFrame:
    """Plan awards absent from the active list."""
    return anti_join_ns(plan.select("award_number").distinct(), active.select("award_number"), "award_number")
