"""The membership filter, and key resolution that reads its lines once."""

import contextlib
import io

from hypothesis import given, settings
from hypothesis import strategies as st

from fundflow.operators import measure_keys, resolve_key, stage
from fundflow.operators.membership import bits_for, maybe_members, member_filter
from fundflow.plans import feeds

KEYS = "award_number string"


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("AZ09", max_size=4)), max_size=40),
       st.lists(st.one_of(st.none(), st.text("AZ09", max_size=4)), max_size=40))
def test_filter_keeps_every_member(spark, keys, rows):
    k = spark.createDataFrame([(x,) for x in keys], KEYS)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string")
    got = {r["i"] for r in maybe_members(df, "x", member_filter(k, "award_number")).collect()}
    members = {i for i, x in enumerate(rows) if x is not None and x in keys}
    # 40 keys in 2^24 bits: a false positive is next to impossible.
    assert got == members


def test_filter_is_of_fixed_size(spark):
    keys = spark.range(300_000).selectExpr("concat('K', id) AS award_number")
    f = member_filter(keys, "award_number", 20)
    assert f.count() <= 2 ** 20 // 32768 and f.selectExpr("max(length(__map)) AS n").first()["n"] == 4096
    full = maybe_members(keys.withColumnRenamed("award_number", "x"), "x", f, 20)
    assert full.count() == 300_000
    assert (bits_for(None), bits_for(10), bits_for(10 ** 7), bits_for(10 ** 12)) == (24, 24, 27, 27)


LINES = "award_number string, document_number string, period string, amt double"


def test_written_resolution_equals_the_broadcast_one(spark):
    rows = [("A1", "A2", "p", 1.0), ("ZZ", "A2", "p", 2.0), (None, "A1", None, 3.0), ("ZZ", None, "p", 4.0), (None, None, "q", 5.0),
            ("A3", "ZZ", "q", 6.0)] + [("HOT", f"D{i}", "p", 1.0) for i in range(300)] + [("HOT", "D", "p", 1.0)] * 300
    lines = spark.createDataFrame(rows, LINES)
    keys = spark.createDataFrame([("A1",), ("A2",), ("HOT",), (None,)], KEYS)
    cands = ["award_number", "document_number"]
    small = measure_keys(keys.dropna())
    seen = []
    for keep in (False, True):
        want = sorted(map(repr, resolve_key(lines, small, cands, keep_unmatched=keep).collect()))
        for cut in (None, lambda df: seen.append(1) or stage(df, "t")):
            got = resolve_key(lines, keys, cands, keep_unmatched=keep, cut=cut)
            assert sorted(map(repr, got.select(*lines.columns).collect())) == want
    assert len(seen) == 4  # lines and chosen keys, twice


def test_lines_are_scanned_once(spark, scratch):
    """The ledger's raw lines are read by the job that writes the pre-aggregation, by nothing after it."""
    from fundflow.plans.roles import DriverFlow
    import os
    import pytest
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    f = DriverFlow(spark, sf)
    plans = []

    def cut(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        plans.append(out.getvalue())
        return stage(df, "t")

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        feeds.ledger(f.raw_ledger, f.all_keys.df, f.cfg, cut).explain()
    scans = [p.count("orders.parquet") for p in [*plans, out.getvalue()]]
    assert len(plans) == 2 and scans == [1, 0, 0]
