"""Joins, aggregations, key resolution: N1-N3, N14-N16, G4, G4b, G7, G8, G13."""

from pyspark.sql import functions as F

from fundflow.operators import (
    KeySet,
    combine_sums,
    full_join_ns,
    latest_period,
    left_join_ns,
    measure_keys,
    nan_to_null,
    partial_sums,
    resolve_key,
    running_total,
    semi_join_ns,
    spread_attribute,
    stage,
    sum_all_numeric,
    zero_fill_numeric,
)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_left_join_null_keys_match_n1(spark):
    a = spark.createDataFrame([("A1", None, 1), ("A2", "x", 2)], "k string, area string, a int")
    b = spark.createDataFrame([("A1", None, 10), ("A2", None, 20)], "k string, area string, b int")
    out = left_join_ns(a, b, ["k", "area"])
    assert out.columns == ["k", "area", "a", "b"]
    assert rows(out, "k", "area", "b") == [("A1", None, 10), ("A2", "x", None)]


def test_join_suffixes_and_full_coalesce(spark):
    a = spark.createDataFrame([("A1", "p"), ("A2", "q")], "k string, v string")
    b = spark.createDataFrame([("A2", "r"), ("A3", "s")], "k string, v string")
    out = full_join_ns(a, b, "k")
    assert out.columns == ["k", "v_x", "v_y"]
    assert rows(out, "k", "v_x", "v_y") == [("A1", "p", None), ("A2", "q", "r"), ("A3", None, "s")]


def test_many_to_many_multiplies(spark):
    a = spark.createDataFrame([("A1", 1), ("A1", 2)], "k string, a int")
    b = spark.createDataFrame([("A1", 10), ("A1", 20)], "k string, b int")
    assert left_join_ns(a, b, "k").count() == 4
    assert semi_join_ns(a, b, "k").count() == 2


def test_strict_and_lenient_sums_g4(spark):
    df = spark.createDataFrame([("g1", 1.0), ("g1", None), ("g2", None)], "g string, x double")
    strict = dict(rows(sum_all_numeric(df, ["g"], strict=True), "g", "x"))
    lenient = dict(rows(sum_all_numeric(df, ["g"]), "g", "x"))
    assert strict == {"g1": None, "g2": None}
    assert lenient == {"g1": 1.0, "g2": 0.0}


def test_two_level_sums_equal_one_level(spark):
    df = spark.createDataFrame([("a", "d1", 1.0), ("a", "d1", None), ("a", "d2", 2.0), ("b", "d3", 4.0),
                                ("b", "d4", 5.0), ("c", "d5", None)], "g string, sub string, x double")
    pre = partial_sums(df, ["g", "sub"], ["x"])
    for strict in (True, False):
        assert rows(combine_sums(pre, ["g"], ["x"], strict), "g", "x") == \
            rows(sum_all_numeric(df.select("g", "x"), ["g"], strict=strict), "g", "x")


def test_zero_fill_and_nan_n14(spark):
    df = spark.createDataFrame([("a", float("nan"), None), ("b", None, 3)], "k string, x double, n int")
    z = dict((r["k"], (r["x"], r["n"])) for r in zero_fill_numeric(df).collect())
    assert z == {"a": (0.0, 0), "b": (0.0, 3)}
    nn = dict((r["k"], r["x"]) for r in nan_to_null(df).collect())
    assert nn == {"a": None, "b": None}


def test_latest_period_g13(spark):
    df = spark.createDataFrame([("A1", "FY24Q1"), ("A2", "FY24Q2"), ("A3", None)], "k string, period string")
    assert rows(latest_period(df), "k", "period") == [("A2", "FY24Q2")]


def test_running_total_g4b(spark):
    df = spark.createDataFrame(
        [("A1", 2024, 1, "HL.1", 10.0), ("A1", 2024, 3, "HL.1", 5.0), ("A1", 2025, 1, "HL.1", 7.0),
         ("A1", 2024, 1, "HL.2", 0.0)], "award string, fy int, q int, area string, disb double")
    out = running_total(df, "disb", ["award", "fy", "area"], ["q"], "cum")
    assert rows(out, "area", "fy", "q", "cum") == [
        ("HL.1", 2024, 1, 10.0), ("HL.1", 2024, 3, 15.0), ("HL.1", 2025, 1, 7.0), ("HL.2", 2024, 1, 0.0)]


def test_spread_attribute(spark):
    df = spark.createDataFrame([("A1", "P", "x", "c1"), ("A1", "P", "y", "c2"), ("A1", "P", "z", None),
                                ("A2", "P", "x", None)], "k string, period string, area string, comments string")
    out = spread_attribute(df, ["k", "period"], "comments")
    assert out.count() == 7
    assert rows(out.filter(F.col("k") == "A2"), "area", "comments") == [("x", None)]


def _keyed(spark, data, cols):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))


def test_resolve_key_two_step_g7(spark, scratch):
    keys = spark.createDataFrame([("A1",), ("A2",)], "award_number string")
    df = _keyed(spark, [("1", "A1", "X"), ("2", "Z", "A2"), ("3", None, "A1"), ("4", "Z", "Z")],
                ["id", "award_number", "document_number"])
    for k in (keys, measure_keys(stage(keys, "test_keys"))):
        out = resolve_key(df, k, ["award_number", "document_number"])
        assert rows(out, "id", "award_number") == [("1", "A1"), ("2", "A2"), ("3", "A1")]


def test_resolve_key_three_step_g8(spark):
    keys = spark.createDataFrame([("A1",)], "award_number string")
    measured = measure_keys(keys)
    assert isinstance(measured, KeySet) and measured.rows == 1 and measured.broadcastable()
    df = _keyed(spark, [("1", "Z", "A1", "Q"), ("2", "Z", "Z", "A1"), ("3", "A2", "Z", "Z")],
                ["id", "award_number", "document_number", "obl_document_number"])
    for k in (keys, measured):
        out = resolve_key(df, k, ["award_number", "document_number", "obl_document_number"])
        assert rows(out, "id", "award_number") == [("1", "A1"), ("2", "A1")]


def test_measured_keys_beyond_limit_not_broadcast(spark):
    keys = spark.createDataFrame([("A1",), ("A2",)], "award_number string")
    ks = measure_keys(keys)
    assert not ks.broadcastable(limit=10)
    assert ks.broadcastable(limit=10_000)


def test_max_all_numeric_a4(spark):
    from fundflow.operators import max_all_numeric
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", None, 2)], "k string, x double, n int")
    out = {r["k"]: (r["x"], r["n"]) for r in max_all_numeric(df, ["k"]).collect()}
    assert out == {"a": (3.0, None), "b": (None, 2)}


def test_union_keys_distinct_q19(spark):
    from fundflow.operators import key_set, union_keys
    active = spark.createDataFrame([("A1",), ("A2",), (None,)], "award_number string")
    expired = spark.createDataFrame([("A2",), ("E1",)], "award_number string")
    assert sorted(r["award_number"] for r in union_keys(key_set(active), key_set(expired)).collect()) == \
        ["A1", "A2", "E1"]


def test_anti_join_j6(spark):
    from fundflow.operators import anti_join_ns
    a = spark.createDataFrame([("A1",), ("A3",), (None,)], "k string")
    b = spark.createDataFrame([("A1",), ("A1",)], "k string")
    assert sorted(r["k"] or "" for r in anti_join_ns(a, b, "k").collect()) == ["", "A3"]


def test_resolve_key_copies_of_the_key_set_are_not_broadcast(spark):
    """A small unmeasured key set is copied for the salted join; the planner's size of it is that of one copy."""
    keys = spark.createDataFrame([("A1",), ("A2",)], "award_number string")
    df = spark.createDataFrame([("A1", "X", 1), ("Z", "A2", 2), (None, "A1", 3), ("Z", "Z", 4), ("A2", "A1", 5)],
                               "award_number string, document_number string, n int")
    got = resolve_key(df, keys, ["award_number", "document_number"])
    assert sorted(rows(got, "n", "award_number", "document_number")) == [
        (1, "A1", "X"), (2, "A2", "A2"), (3, "A1", "A1"), (5, "A2", "A1")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "__salt" in x]
