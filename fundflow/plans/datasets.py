"""Reporting datasets.

Join order follows the source exactly (a chain of left joins is
order-sensitive), keys match NULL to NULL, and row fan-out from
many-to-many matches is kept: these are the report's semantics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.config import DEFAULT, FlowConfig
from fundflow.functions import area_name, matches_any
from fundflow.operators import (
    in_keys,
    key_set,
    latest_period,
    left_join_ns,
    lenient_sum,
    semi_join_ns,
    running_total,
    zero_fill_numeric,
)
from fundflow.operators.layout import drop_key_texts, key_name, key_text, lay_out, left_join_laid_out
from fundflow.plans.feeds import transactions

AP = ["award_number", "period"]
APA = ["award_number", "period", "program_area"]


def cumulative_transactions(txn_rollup: DataFrame) -> DataFrame:
    """D0 from the F6 roll-up: running disbursement total within award x
    fiscal year x area, ordered by quarter.  Quarters without activity get
    no row.  The roll-up key is unique, so the running total is added in
    place (no self re-join); its window shuffles only the rolled-up rows."""
    df = running_total(txn_rollup, "transaction_disbursement",
                       ["award_number", "fiscal_year", "program_area"], ["quarter"],
                       "cumulative_transaction_disbursement_fy")
    return df.drop("fiscal_year", "quarter")


def transaction_history(raw_txn: DataFrame, active_keys: DataFrame, cfg: FlowConfig = DEFAULT,
                        cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D0 straight from the landed transaction extracts (all periods)."""
    return cumulative_transactions(transactions(raw_txn, active_keys, cfg, cut))


def pipeline_dataset(active: DataFrame, ledger: DataFrame, plan: DataFrame, txn: DataFrame,
                     cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Active award-periods LEFT ledger (award, period) LEFT plan and
    LEFT transactions (award, period, area); numeric NULLs -> 0, area
    name added, and the plan comments of each award-period spread to all
    its rows (one row per distinct comment).

    The distinct comments are taken without the transaction join (a left
    join neither drops rows nor changes (award, period, comment), so the
    set is the same), so the comment branch does not re-run the
    transaction roll-up.  Active LEFT ledger is read by both branches: ``cut``
    writes it and reads it back (:func:`fundflow.operators.stage`).
    """
    base = left_join_ns(active, ledger, AP)
    if cut is not None and "comments" in plan.columns:
        base = cut(base)
    df = left_join_ns(base, plan, APA)
    comments = None
    if "comments" in plan.columns:
        # A comment reaches the joined frame iff its plan row matches some
        # (award, period, area) of active LEFT ledger: a semi join gives that
        # set without fanning plan rows out over ledger agreements first.
        commented = plan.select(*APA, "comments").dropna(subset=["comments"])
        comments = semi_join_ns(commented, base.select(*APA), APA).select(*AP, "comments").distinct()
        df = df.drop("comments")
    df = left_join_ns(df, txn, APA)
    df = zero_fill_numeric(df)
    df = df.withColumn("program_area_name", area_name("program_area"))
    if comments is not None:
        df = left_join_ns(df, comments, AP)
    return df


def pipeline_laid_out(active: DataFrame, ledger: DataFrame, plan: DataFrame, txn: DataFrame) -> DataFrame:
    """:func:`pipeline_dataset` of inputs that :func:`lay_out_inputs` has
    written by award and period: the chain of left joins, the comments' semi
    join, their distinct and the last join all read bucket by bucket, so none
    of them exchanges rows."""
    base = left_join_laid_out(active, ledger, AP)
    # The ledger's area is what plan and transactions are joined by.
    base = base.withColumn(key_name("program_area"), key_text("program_area"))
    comments = None
    if "comments" in plan.columns:
        commented = plan.filter(F.col("comments").isNotNull()).select(*[key_name(c) for c in APA], "comments")
        areas = base.select(*[key_name(c) for c in APA])
        comments = (left_join_laid_out(commented, areas, APA, "left_semi")
                    .select(*[key_name(c) for c in AP], "comments").distinct())
        plan = plan.drop("comments")
    df = left_join_laid_out(base, plan, APA)
    df = left_join_laid_out(df, txn, APA)
    df = zero_fill_numeric(df).withColumn("program_area_name", area_name("program_area"))
    if comments is not None:
        df = left_join_laid_out(df, comments, AP)
    return drop_key_texts(df)


def lay_out_inputs(active: DataFrame, ledger: DataFrame, plan: DataFrame, txn: DataFrame,
                   buckets: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The inputs of :func:`pipeline_laid_out`, each written once in buckets
    of award and period.  A hot award is spread over its periods."""
    return (lay_out(active, "active", AP, buckets=buckets), lay_out(ledger, "ledger", AP, (), buckets, keep=False),
            lay_out(plan, "plan", AP, ["program_area"], buckets, keep=False),
            lay_out(txn, "txn", AP, ["program_area"], buckets, keep=False))


def latest_accrual(pipeline: DataFrame, latest: Callable[[DataFrame], DataFrame] = latest_period) -> DataFrame:
    """Accrual of the latest period in the pipeline dataset, per award x
    area (NULLs skipped).  ``latest`` picks the rows of the latest period."""
    latest = latest(pipeline)
    return latest.groupBy(*APA).agg(lenient_sum("last_qtr_accrual_amt"))


def transaction_dataset(active: DataFrame, txn: DataFrame, pipeline: DataFrame,
                        latest: Callable[[DataFrame], DataFrame] = latest_period) -> DataFrame:
    """Distinct (award, activity) LEFT D0 on award LEFT latest-period
    accrual (award, period, area); numeric NULLs -> 0; area name.

    ``pipeline`` only feeds the latest-period accrual, so a caller may pass
    the pipeline dataset built from the latest period's active rows alone
    (:func:`latest_period` of ``active``): every pipeline row's period is
    its active row's period, so the result is the same and the large
    joins run for one period instead of all.  Over a written pipeline table
    partitioned by period, :func:`at_latest` as ``latest`` reads one partition.
    """
    base = active.select("award_number", "activity_name").distinct()
    df = left_join_ns(base, txn, "award_number").select(
        "award_number", "activity_name", "transaction_disbursement", "transaction_obligation",
        "transaction_amt", "avg_monthly_exp_rate", "period", "program_area")
    df = left_join_ns(df, latest_accrual(pipeline, latest), APA)
    df = zero_fill_numeric(df)
    return df.withColumn("program_area_name", area_name("program_area"))


def expired_dataset(expired: DataFrame, ledger: DataFrame, close_out: DataFrame,
                    cfg: FlowConfig = DEFAULT, latest: Callable[[DataFrame], DataFrame] = latest_period) -> DataFrame:
    """D3: latest-period expired awards with their ledger undisbursed
    amount per bilateral agreement (tagged new / old) and close-out
    status.

    The latest-period filter is applied to the expired rows before the
    joins: left joins keep every expired row and its period, so the
    maximum and the surviving rows are the same, and the joins only see
    one period.  ``latest`` picks those rows; over a table from
    :func:`fundflow.operators.latest.stage_ordered` they are read by file
    statistics.
    """
    pipe = in_keys(ledger, key_set(expired))
    pipe = (pipe.groupBy("award_number", "period", "bilateral_obl_number")
                .agg(lenient_sum("undisbursed_amt")))
    pipe = pipe.withColumn(
        "doag_new_old",
        F.when(matches_any("bilateral_obl_number", cfg.new_agreements), F.lit("new")).otherwise(F.lit("old")))
    df = left_join_ns(latest(expired), pipe, AP)
    return left_join_ns(df, close_out, AP)
