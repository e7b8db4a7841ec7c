"""One quarterly run: landing folders in, reporting datasets and checks out.

    from fundflow.plans.run import run_quarter
    run_quarter(spark, "<landing root>", "<output root>")

Landing layout (one folder per feed, period files named ``FY24Q1_*``)::

    <landing>/active_awards/        F1 (also F2 with ``expired_from_active_folder``)
    <landing>/expired_awards/       F2
    <landing>/close_out_tracker/    F3
    <landing>/subobligation_summary/  F4
    <landing>/ledger/               F5
    <landing>/transactions/         F6

Intermediates that several outputs read (award lists, key sets, ledger,
transaction history, pipeline dataset) are written once to the shared
checkpoint folder and read back, so every output plan starts from files:
no subtree is recomputed per output, and a lost executor costs a re-read,
not a re-run of the upstream joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fundflow.config import DEFAULT, LEDGER_HEADER_DRIFT, PLAN_HEADER_DRIFT, FlowConfig
from fundflow.operators import at_latest, can_broadcast, key_set, measure_keys, stage, union_keys
from fundflow.operators.latest import stage_ordered
from fundflow.plans import checks, datasets, feeds, rejects
from fundflow.plans.publish import publish
from fundflow.sources import (read_csv_folder, read_landed, read_parquet_folder, read_period_table, sync_landing,
                              write_csv, write_parquet)

FEED_FOLDERS = {
    "active": "active_awards",
    "expired": "expired_awards",
    "closeout": "close_out_tracker",
    "plan": "subobligation_summary",
    "ledger": "ledger",
    "txn": "transactions",
}


# Feeds exported from spreadsheets (a banner row may sit above the header).
SPREADSHEET_FEEDS = ("active", "expired", "closeout", "plan")


@dataclass
class Landing:
    spark: SparkSession
    root: str
    fmt: str = "csv"
    skip_rows: int = 0
    multi_line: bool = True
    #: Tables that follow the landing folders, for runs that read changed files only.
    landed: str | None = None

    def read(self, feed: str, drift=()) -> DataFrame:
        folder = f"{self.root.rstrip('/')}/{FEED_FOLDERS[feed]}"
        if self.landed:
            sheet = self.fmt == "csv" and feed in SPREADSHEET_FEEDS
            table = f"{self.landed.rstrip('/')}/{FEED_FOLDERS[feed]}"
            sync_landing(self.spark, folder, table, self.fmt, drift, multi_line=self.multi_line and sheet,
                         skip_rows=self.skip_rows if sheet else 0)
            return read_landed(self.spark, table)
        if self.fmt == "parquet":
            return read_parquet_folder(self.spark, folder, drift)
        if self.fmt == "table":          # period-partitioned tables written by the streaming ingest
            return read_period_table(self.spark, folder, drift)
        sheet = feed in SPREADSHEET_FEEDS
        return read_csv_folder(self.spark, folder, drift, multi_line=self.multi_line and sheet,
                               skip_rows=self.skip_rows if sheet else 0)


def build(spark: SparkSession, landing_root: str, cfg: FlowConfig = DEFAULT, fmt: str = "csv",
          expired_from_active_folder: bool = False, skip_rows: int = 0,
          multi_line: bool = True, landed_root: str | None = None) -> dict[str, DataFrame]:
    """Every dataset and check of one run as DataFrames (shared intermediates
    already staged), and the cells that could not be read.  ``skip_rows`` banner lines are skipped
    in the CSV exports of the four spreadsheet feeds, whose quoted cells may
    hold line breaks (``multi_line``).  With ``landed_root`` the landing is
    followed by tables there, and only files that are new or changed since
    the last run are read."""
    land = Landing(spark, landing_root, fmt, skip_rows, multi_line, landed_root)
    raw_active = land.read("active")
    raw_expired = raw_active if expired_from_active_folder else land.read("expired")
    active, cells = rejects.active_awards(raw_active, lambda df: stage(df, "active"), cfg)
    quarantine = [cells]
    ordered = stage_ordered(feeds.expired_awards(raw_expired, cfg), "expired")
    expired = ordered.rows
    active_keys = measure_keys(stage(key_set(active), "active_keys"))
    all_keys = measure_keys(stage(union_keys(key_set(active), key_set(expired)), "all_keys"))
    closeout = feeds.close_out(land.read("closeout"))
    plan, cells = rejects.plan(land.read("plan", PLAN_HEADER_DRIFT), lambda df: stage(df, "plan"), cfg)
    quarantine.append(cells)
    ledger, cells = rejects.ledger(land.read("ledger", LEDGER_HEADER_DRIFT), all_keys, _resolved, cfg)
    quarantine.append(cells)
    rolled, cells = rejects.transactions(land.read("txn"), active_keys, _resolved, cfg)
    quarantine.append(cells)
    txn = stage(datasets.cumulative_transactions(rolled), "txn")
    if can_broadcast(active_keys):  # roll-ups by award are small too
        pipeline = datasets.pipeline_dataset(active, ledger, plan, txn, cut=lambda df: stage(df, "base"))
    else:
        pipeline = datasets.pipeline_laid_out(*datasets.lay_out_inputs(active, ledger, plan, txn))
    pipeline = stage(pipeline, "pipeline", partition_by=("period",))
    txn_ds = datasets.transaction_dataset(active, txn, pipeline, latest=at_latest)
    return {
        "pipeline": pipeline,
        "transaction": txn_ds,
        "expired_awards": datasets.expired_dataset(expired, ledger, closeout, cfg, lambda _: ordered.latest()),
        "awards_exist": checks.coverage_awards(active, plan, ledger, txn),
        "program_area_missing": checks.missing_area(active, plan),
        "program_area_all_datasets": checks.coverage_areas(active, plan, txn, ledger, active_keys),
        "po_2_test": checks.area_spotlight(active, ledger, txn, active_keys, cfg),
        "pipeline_test_all": checks.recon_ledger(ledger, active, pipeline),
        "activities": checks.distinct_activities(active),
        "plan_awards_not_active": checks.plan_awards_not_active(plan, active),
        "rejected_cells": rejects.all_cells(quarantine),
    }


def _resolved(df: DataFrame) -> DataFrame:
    return stage(df, "resolve")


WRITTEN = ("pipeline", "transaction", "expired_awards", "awards_exist", "program_area_missing",
           "program_area_all_datasets", "po_2_test", "pipeline_test_all")


def run_quarter(spark: SparkSession, landing_root: str, out_root: str, cfg: FlowConfig = DEFAULT,
                fmt: str = "csv", out_fmt: str = "csv", expired_from_active_folder: bool = False,
                skip_rows: int = 0, multi_line: bool = True, landed_root: str | None = None) -> list[str]:
    """Build and write the eight outputs of a run; returns their paths."""
    outs = build(spark, landing_root, cfg, fmt, expired_from_active_folder, skip_rows, multi_line, landed_root)
    paths = []
    for name in WRITTEN:
        path = f"{out_root.rstrip('/')}/{name}"
        if out_fmt == "parquet":
            write_parquet(outs[name], path, partition_by=("period",) if name == "pipeline" else ())
        else:
            write_csv(outs[name], path)
        paths.append(path)
    return paths


def publish_quarter(spark: SparkSession, landing_root: str, out_root: str, cfg: FlowConfig = DEFAULT,
                    out_fmt: str = "csv", run_id: str | None = None, **options) -> str:
    """Build the outputs of a run and the quarantined cells, and publish them
    all or none (:mod:`fundflow.plans.publish`); returns the run's folder.
    ``options`` are those of :func:`build`."""
    outs = build(spark, landing_root, cfg, **options)
    return publish(spark, {n: outs[n] for n in (*WRITTEN, "rejected_cells")}, out_root, out_fmt,
                   {"pipeline": ("period",)}, run_id)


def main(argv: list[str] | None = None) -> None:
    """``python -m fundflow.plans.run LANDING OUT [--format parquet] [--out-format parquet]``"""
    import argparse

    from fundflow.session import get_spark

    ap = argparse.ArgumentParser(description="One quarterly run: landing folders -> reporting datasets + checks")
    ap.add_argument("landing")
    ap.add_argument("out")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet", "table"])
    ap.add_argument("--out-format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--sector", default=DEFAULT.active_sector)
    ap.add_argument("--expired-from-active-folder", action="store_true")
    ap.add_argument("--lenient-ledger", action="store_true", help="sum ledger amounts skipping NULLs")
    ap.add_argument("--landed", help="tables that follow the landing: only changed files are read")
    ap.add_argument("--publish", action="store_true", help="all outputs or none, under <out>/runs, named in <out>/published")
    ap.add_argument("--skip-rows", type=int, default=0, help="banner rows above the header of spreadsheet CSVs")
    args = ap.parse_args(argv)
    from dataclasses import replace

    cfg = replace(DEFAULT, active_sector=args.sector, expired_sector=args.sector,
                  strict_ledger_sum=not args.lenient_ledger)
    spark = get_spark()
    if args.publish:
        print(publish_quarter(spark, args.landing, args.out, cfg, args.out_format, fmt=args.format, landed_root=args.landed,
                              expired_from_active_folder=args.expired_from_active_folder, skip_rows=args.skip_rows))
        return
    for p in run_quarter(spark, args.landing, args.out, cfg, args.format, args.out_format,
                         args.expired_from_active_folder, args.skip_rows, landed_root=args.landed):
        print(p)


if __name__ == "__main__":
    main()
