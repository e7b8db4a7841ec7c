"""Reconciliation checks in one aggregation, against the joins they stand for in plain Python."""

import math

from fundflow.plans import checks

M = ("document_amt", "disbursement_amt", "last_qtr_accrual_amt", "undisbursed_amt")
LEDGER = [("A", "p", 1., 2., 3., 4.), ("A", "p", None, 2., 3., 4.), ("A", None, 5., 5., 5., 5.), ("B", "p", 1., 1., math.nan, 1.),
          ("C", "p", 1., 1., 1., 1.), (None, "p", 9., 9., 9., 9.), ("D", "q", 1., 1., 1., 1.)]
ACTIVE = [("A", "x", "p", 1.), ("A", "x", "p", 2.), ("A", "y", "p", 1.), ("A", "x", "p", 1.), ("A", "z", None, 0.), ("B", None, "p", 1.),
          ("B", "w", "p", None), ("Z", "q", "p", 1.), (None, "n", "p", 3.)]
PIPELINE = [("A", "x", "p", 1., 1., 1., 1.), ("A", "x", "p", 1., 1., 1., 1.), ("A", "z", None, 7., 7., 7., 7.), ("B", None, "p", 2., 2., 2., 2.),
            ("C", None, "p", 3., 3., 3., 3.), ("C", "u", "p", 4., 4., 4., 4.), ("Z", "q", "p", 1., 1., 1., 1.), (None, "n", "p", 1., 1., None, 1.)]


def total(values):
    return sum(v for v in values if v is not None and not math.isnan(v))


def expected_k8():
    raw = {}
    for a, p, *m in LEDGER:
        raw.setdefault((a, p), []).append(m)
    new = {}
    for a, n, p, *m in PIPELINE:
        new.setdefault((a, p, n), []).append(m)
    listed = {(a, n, c, p) for a, n, p, c in ACTIVE}
    out = []
    for (a, p), lines in raw.items():
        for n in [n for b, n, _, q in listed if (b, q) == (a, p)] or [None]:
            r = [total(x) for x in zip(*lines)]
            w = [total(x) for x in zip(*new.get((a, p, n), [[0.0] * 4]))]
            out.append((a, n, p, *[v for x, y in zip(r, w) for v in (x, y, x - y)]))
    return sorted(out, key=repr)


def test_ledger_reconciliation(spark):
    amounts = ", ".join(f"{m} double" for m in M)
    ledger = spark.createDataFrame(LEDGER, f"award_number string, period string, {amounts}")
    active = spark.createDataFrame(ACTIVE, "award_number string, activity_name string, period string, total_estimated_cost double")
    pipeline = spark.createDataFrame(PIPELINE, f"award_number string, activity_name string, period string, {amounts}")
    got = checks.recon_ledger(ledger, active, pipeline)
    assert got.columns[:6] == ["award_number", "activity_name", "period", "raw_document_amt", "new_document_amt", "document_dif"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_k8()
    assert checks.recon_ledger(ledger.limit(0), active, pipeline).count() == 0


def test_transaction_reconciliation(spark):
    txn = [("A", "p", 1.), ("A", "p", 2.), ("A", "q", None), ("B", "p", 4.), (None, None, 5.)]
    reported = [("A", "p", 3.), ("A", "p", 3.), ("B", "z", 1.), (None, None, math.nan)]
    active = [("A", "x"), ("A", "x"), ("A", None), (None, "n")]
    schema = "award_number string, period string, transaction_amt double"
    got = checks.recon_txn_pipeline(spark.createDataFrame(txn, schema),
                                    spark.createDataFrame(active, "award_number string, activity_name string"),
                                    spark.createDataFrame(reported, schema))
    # A has two names: once each on the raw side, and on the reported side where there is one.
    want = [("A", "p", 3., 6., -3.)] * 4 + [("A", "q", 0., 0., 0.)] * 2 + [("B", "p", 4., 0., 4.), (None, None, 5., 0., 5.)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_area_coverage(spark):
    active = spark.createDataFrame([("A", "p"), ("A", None)], "award_number string, period string")
    schema = "award_number string, period string, program_area string"
    plan = spark.createDataFrame([("A", "p", "1"), ("A", "p", None), ("B", "p", "2"), ("A", None, "3")], schema)
    txn = spark.createDataFrame([("A", "p", "1"), ("A", "r", None), ("B", "p", "9")], schema)
    ledger = spark.createDataFrame([("A", "p", "1"), ("A", "p", "1"), ("A", "p", "4")], schema)
    keys = spark.createDataFrame([("A",)], "award_number string")
    got = checks.coverage_areas(active, plan, txn, ledger, keys)
    assert got.columns == ["program_area", "period", "subobligation", "pipeline", "transaction"]
    assert [tuple(r) for r in got.collect()] == [("1", "p", "yes", "yes", "yes"), ("4", "p", None, "yes", None),
                                                 (None, "r", None, None, "yes"), ("3", None, "yes", None, None)]
