"""D1 over tables laid out by award and period: the same rows, no exchange."""

import contextlib
import io

import pytest

from fundflow.operators.layout import lay_out, left_join_laid_out
from fundflow.plans import datasets


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


ACTIVE = [("A1", "p1", "act", 5.0), ("A1", "p2", None, 0.0), ("A1", None, "n", 1.0), ("A2", "p1", "b", 2.0), ("A2", "p1", "c", 3.0),
          ("", "p1", "empty", 4.0), ("A9", "p9", "alone", 9.0)]
LEDGER = [("A1", "p1", "PO.2", "B1", 1.0), ("A1", "p1", "PO.2", "B2", None), ("A1", "p1", None, "B1", 3.0), ("A1", None, "PO.1", "B", 4.0),
          ("A2", "p1", "PO.2", "B", 5.0), (None, "p1", "PO.2", "B", 6.0), ("", "p1", "", "B", 7.0)]
PLAN = [("A1", "p1", "PO.2", 1.0, "c1"), ("A1", "p1", "PO.2", 2.0, "c2"), ("A1", "p1", None, 3.0, "c3"), ("A1", "p1", "PO.9", 4.0, "c4"),
        ("A1", None, "PO.1", 5.0, "c5"), ("A2", "p1", "PO.2", 6.0, None), ("", "p1", "", 7.0, "c6")]
TXN = [("A1", "p1", "PO.2", 10.0), ("A1", "p1", None, 20.0), ("A1", None, "PO.1", 30.0), ("A2", "p2", "PO.2", 40.0)]


def inputs(spark):
    return (spark.createDataFrame(ACTIVE, "award_number string, period string, activity_name string, total_estimated_cost double"),
            spark.createDataFrame(LEDGER, "award_number string, period string, program_area string, bilateral_obl_number string, document_amt double"),
            spark.createDataFrame(PLAN, "award_number string, period string, program_area string, un_sub_obligated_funds double, comments string"),
            spark.createDataFrame(TXN, "award_number string, period string, program_area string, transaction_amt double"))


@pytest.mark.parametrize("with_comments", [True, False])
def test_same_rows_without_an_exchange(spark, no_broadcast, with_comments):
    active, ledger, plan, txn = inputs(spark)
    plan = plan if with_comments else plan.drop("comments")
    want = datasets.pipeline_dataset(active, ledger, plan, txn)
    got = datasets.pipeline_laid_out(*datasets.lay_out_inputs(active, ledger, plan, txn, buckets=3))
    plan, before = plan_of(got), plan_of(want)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == (6 if with_comments else 3)
    assert before.count("Exchange hash") >= (6 if with_comments else 4)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_empty_inputs(spark):
    active, ledger, plan, txn = (df.limit(0) for df in inputs(spark))
    got = datasets.pipeline_laid_out(*datasets.lay_out_inputs(active, ledger, plan, txn, buckets=2))
    assert got.count() == 0


def test_columns_on_both_sides_are_refused(spark):
    a = lay_out(spark.createDataFrame([("x", 1)], "k string, v int"), "a", ["k"], buckets=2)
    with pytest.raises(ValueError, match="both sides: v"):
        left_join_laid_out(a, a, ["k"])
