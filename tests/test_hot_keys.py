"""Joins with a key that holds a third of the rows on both sides."""

import pytest
from pyspark.sql import functions as F

from fundflow.operators import left_join_ns, spread_attribute
from fundflow.operators.hot_keys import heavy_keys, left_join_hot, spread_attribute_hot


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def tables(spark):
    left = [("HOT" if i % 3 == 0 else None if i % 3 == 1 and i < 200 else f"K{i}", "p", i, "l") for i in range(600)]
    right = [("HOT" if i % 3 == 0 else f"K{i}", "p", i, "r") for i in range(90)] + [(None, "p", -1, "r"), (None, "p", -2, "r"), ("no", "p", 0, "r")]
    schema = "k string, period string, {} int, same string"
    return spark.createDataFrame(left, schema.format("a")), spark.createDataFrame(right, schema.format("b"))


def test_heavy_keys(spark, tables):
    left, _ = tables
    assert len(heavy_keys(left, ["k"])) == 2 and len(heavy_keys(left, ["k", "period"])) == 2
    assert len(heavy_keys(left, ["k"], share=0.2)) == 1 and heavy_keys(left, ["k"], share=0.9) == []
    assert heavy_keys(left.limit(0), ["k"]) == []
    # Columns do not run into each other, and NULL is no text.
    pairs = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("~", None), (None, "~")] * 5, "x string, y string")
    assert len(set(heavy_keys(pairs, ["x", "y"], share=0.1))) == 4


@pytest.mark.parametrize("on", ["k", ["k", "period"]])
def test_same_rows_as_the_plain_join(tables, on):
    left, right = tables
    got, want = left_join_hot(left, right, on, salts=7), left_join_ns(left, right, on)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_hot_rows_are_spread(spark, tables):
    """With sort-merge joins the hot key's rows come out of many partitions; of the plain join, out of one."""
    left, right = tables
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(old, ("-1", "false", "16")):
        spark.conf.set(k, v)
    try:
        def partitions(df):
            hot = df.filter("k = 'HOT'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
            return sorted((r["count"] for r in hot), reverse=True)

        plain, spread = partitions(left_join_ns(left, right, "k")), partitions(left_join_hot(left, right, "k", salts=16))
        assert len(plain) == 1 and sum(plain) == sum(spread) == 200 * 30
        assert len(spread) >= 8 and spread[0] <= plain[0] / 3
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_spread_attribute(tables):
    left, _ = tables
    df = left.withColumn("note", F.when(F.col("a") % 100 == 0, F.concat(F.lit("n"), F.col("a"))))
    assert rows(spread_attribute_hot(df, ["k", "period"], "note")) == rows(spread_attribute(df, ["k", "period"], "note"))


def test_without_heavy_keys_and_without_rows(tables):
    left, right = tables
    thin = left.filter("k LIKE 'K%'")
    assert rows(left_join_hot(thin, right, "k", heavy=[])) == rows(left_join_ns(thin, right, "k"))
    assert left_join_hot(left.limit(0), right, "k").count() == 0
