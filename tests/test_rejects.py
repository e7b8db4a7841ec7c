"""Unreadable cells: found in the pass that makes the feed, which stays the same."""

import pytest

from fundflow.functions import REJECT_COLUMNS, mark_rejects
from fundflow.operators import measure_keys, stage
from fundflow.plans import feeds, rejects
from fundflow.schemas import LEDGER, TRANSACTIONS


def rows(df):
    return sorted(map(repr, df.collect()))


def test_mark_rejects(spark):
    df = spark.createDataFrame([("f", "1", "2024-01-31", "45000", "x"), ("f", "1,5", "soon", "n/a", "x"), (None, " ", None, "", "y"),
                                ("g", "0x1F", "240131", "45000.5", "z")],
                               "source_file string, n string, d string, s string, other string")
    out = mark_rejects(df, ["n", "absent"], ["d"], ["s"])
    assert out.columns == [*df.columns, *REJECT_COLUMNS]
    assert rows(out.filter("reject_column IS NULL").drop(*REJECT_COLUMNS)) == rows(df)
    cells = sorted(tuple(r) for r in out.filter("reject_column IS NOT NULL").select(*REJECT_COLUMNS).collect())
    assert cells == [("f", "d", "soon"), ("f", "n", "1,5"), ("f", "s", "n/a")]
    typed = spark.createDataFrame([(1.0,)], "n double")
    assert mark_rejects(typed, ["n"]).count() == 1


def lines(spark, schema, some):
    names = [f.name for f in schema.fields]
    data = [tuple(r.get(n) for n in [*names, "period", "source_file"]) for r in some]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in [*names, "period", "source_file"]))


@pytest.mark.parametrize("known", [True, False])
def test_roll_ups_are_those_of_the_plain_feeds(spark, known):
    """With a broadcast and with a shuffled key set; cells of unknown awards count too."""
    cut = lambda df: stage(df, "t")
    base = {"obligation_type": "OBLG_UNI", "distribution": "656-M", "program_element": "A047", "period": "FY24Q1",
            "bilateral_obl_number": "B", **{c: "1" for c in ("document_amt", "disbursement_amt", "undisbursed_amt",
                                                             "last_qtr_accrual_amt", "pipeline_amt")}}
    some = [{**base, "award_number": "A1", "source_file": "a"}, {**base, "award_number": "A1", "document_amt": "1,2", "source_file": "b"},
            {**base, "award_number": "ZZ", "document_number": "A2", "document_amt": "1,2", "disbursement_amt": "?", "source_file": "b"},
            {**base, "award_number": "ZZ", "document_amt": "1,2", "source_file": "b"},
            {**base, "award_number": "A1", "distribution": "other", "document_amt": "bad", "source_file": "b"},
            {**base, "award_number": "A1", "document_amt": None, "source_file": "a"}]
    raw = lines(spark, LEDGER, some)
    keys = spark.createDataFrame([("A1",), ("A2",)], "award_number string")
    keys = measure_keys(keys) if known else keys
    data, cells = rejects.ledger(raw, keys, cut)
    plain = feeds.ledger(raw, keys)
    assert data.columns == plain.columns and rows(data) == rows(plain)
    assert sorted((r["source_file"], r["column_name"], r["text"], r["n"]) for r in cells.collect()) == [
        ("b", "disbursement_amt", "?", 1), ("b", "document_amt", "1,2", 3)]

    base = {"distribution": "656-W", "transaction_date": "45000", "transaction_amt": "5", "transaction_event": "DISB",
            "transaction_event_type": "OTHER", "program_element": "A047", "period": "FY24Q1", "source_file": "t"}
    some = [{**base, "award_number": "A1"}, {**base, "award_number": None, "document_number": "A2", "transaction_date": "someday"},
            {**base, "award_number": "no", "transaction_amt": "x"}] * 3
    raw = lines(spark, TRANSACTIONS, some)
    data, cells = rejects.transactions(raw, keys, cut)
    plain = feeds.transactions(raw, keys)
    assert data.columns == plain.columns and rows(data) == rows(plain)
    assert sorted((r["feed"], r["source_file"], r["column_name"], r["text"], r["n"]) for r in cells.collect()) == [
        ("transactions", "t", "transaction_amt", "x", 3), ("transactions", "t", "transaction_date", "someday", 3)]


def test_plan_keeps_its_rows(spark):
    cols = ["award_number", "implementing_mechanism", "program_area", "un_sub_obligated_funds", "planned_sub_oblig_date", "period",
            "source_file"]
    raw = spark.createDataFrame([("A1", "M", "TB", "n/a", "soon", "p", "f"), ("A1", "Total", "TB", "bad", "soon", "p", "f"),
                                 (None, "M", "TB", "bad", None, "p", "f"), ("A2", "M", "TB", "5", "2024-01-31", "p", "f")],
                                ", ".join(f"{c} string" for c in cols))
    data, cells = rejects.plan(raw, lambda df: stage(df, "t"))
    plain = feeds.plan(raw)
    assert data.columns == plain.columns and rows(data) == rows(plain)
    assert sorted((r["column_name"], r["text"], r["n"]) for r in cells.collect()) == [
        ("planned_sub_oblig_date", "soon", 1), ("un_sub_obligated_funds", "n/a", 1)]
