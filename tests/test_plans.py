"""Plan-shape guards for every registered query (read from the public
``explain`` output): no cross / nested-loop joins, no Python evaluation,
no window without a partition key, and the key resolution of the
roll-ups is broadcast only when the key set was measured."""

import contextlib
import io
import os
import re

import pytest

from fundflow.plans import catalog, primitives  # noqa: F401
from fundflow.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    check_plan(name, plan_text(QUERIES[name](spark, SF)))


STAGED_WORK = ["feed_active", "feed_expired", "all_keys", "ledger_rollup", "txn_cumulative", "pipeline_dataset",
               "txn_dataset", "expired_dataset", "recon_ledger", "coverage_areas"]


@pytest.mark.parametrize("name", STAGED_WORK)
def test_plan_guards_without_staging(spark, name, monkeypatch):
    """The same over whole plans, written intermediates included."""
    from fundflow.plans import registry
    monkeypatch.setattr(registry, "STAGED", False)
    text = plan_text(QUERIES[name](spark, SF))
    assert "fundflow-stage" not in text
    check_plan(name, text)


def check_plan(name, text):
    physical = text.split("== Physical Plan ==")[-1]
    for bad in FORBIDDEN:
        assert bad not in physical, f"{name}: {bad}"
    for line in physical.splitlines():
        if re.search(r"\bWindow \[", line):
            assert "], [], [" not in line, f"{name}: window without partition key"


def test_rollup_resolution_is_map_side_when_measured(spark):
    physical = plan_text(QUERIES["txn_rollup"](spark, SF)).split("== Physical Plan ==")[-1]
    # three flag joins against the broadcast key set, partial aggregation before the shuffle
    assert physical.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in physical
    assert "partial_sum" in physical


def test_rollup_preaggregates_when_keys_unmeasured(spark):
    from fundflow.plans import feeds
    from fundflow.plans.roles import DriverFlow

    f = DriverFlow(spark, SF, staged=False)
    df = feeds.transactions(f.raw_txn, f.active_keys, f.cfg)
    physical = plan_text(df).split("== Physical Plan ==")[-1]
    # lines are pre-aggregated on the candidate key columns below the shuffle joins
    pre = [ln for ln in physical.splitlines()
           if "HashAggregate(keys=[award_number" in ln and "document_number" in ln and "obl_document_number" in ln]
    assert pre, physical
    # one join to the key set, salted by a hash of the candidate tuple
    assert "xxhash64" in physical and "__salt" in physical


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_operators_inside_whole_stage_codegen(spark, name):
    """Static plan (adaptive planning off, so codegen stages are visible):
    every projection, filter, aggregation and join is compiled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, SF).explain()
        text = buf.getvalue()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    bad = [ln.strip() for ln in text.splitlines()
           if re.search(r"\b(Project|Filter|HashAggregate|BroadcastHashJoin|SortMergeJoin)\b", ln)
           and not re.search(r"\*\(\d+\)", ln)]
    assert not bad, bad[:3]
