"""Registered queries against their DuckDB SQL, and the pipeline stage by stage."""

import os
from collections import Counter

import pytest
from helpers_llm import DOCS, near_components, words
from pyspark.sql import functions as F

import corpus_pipeline
from fundflow.llm import exact_dedup, langid, mixing, near_dedup, packing
from fundflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plain(v):
    return repr(round(v, 6)) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})")
    assert got == sorted(tuple(map(plain, r)) for r in cur.fetchall())


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_near_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op4_superminhash"](spark, SF).collect()}
    assert got == near_components(docs, 2)


def fixture():
    base = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(base), "en", "a", 1), (2, " ".join(base), None, "a", 1), (3, " ".join(["Zz", *base[1:]]), "en", "b", 1),
            (4, None, "en", "a", 1), (5, "", "en", None, 1), (6, "123 456", "en", "b", 1), (7, "another text " * 900, "en", None, 1)]
    rows += [(10 + i, " ".join(f"q{i}_{k}" for k in range(30 + i)), "en", "hot" if i % 3 else "c", 1) for i in range(40)]
    return rows


def test_pipeline_stages(spark):
    """Every stage works on what its predecessor kept, and its decisions take effect."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mix", "pack"]
    docs = spark.createDataFrame(fixture(), DOCS)
    columns = docs.columns
    kept = [docs]
    for _, fn in corpus_pipeline.STAGES:
        kept.append(fn(spark, kept[-1], SF).cache())
        if len(kept) <= len(corpus_pipeline.STAGES):
            assert kept[-1].columns == columns
    ids = [{r["doc_id"] for r in k.collect()} for k in kept]
    assert ids[1] == ids[0] - {4, 5, 6}                      # no letters
    assert ids[2] == ids[1] - {1}                            # equal texts: the largest id stays
    alive = [(r["doc_id"], r["text"]) for r in kept[2].collect()]
    assert ids[3] == {d for d, (_, c) in near_components(alive, near_dedup.WIDTH).items() if c == d} == ids[2] - {3}
    plan = {r["doc_id"]: len(r["copies"]) for r in mixing.mix_plan(kept[3], whole=True).collect()}
    assert Counter(r["doc_id"] for r in kept[4].collect()) == Counter({d: n for d, n in plan.items() if n})
    words_of = Counter()
    for r in kept[4].collect():
        words_of[r["doc_id"]] += len(words(r["text"])) + 1
    packed = Counter()
    for r in kept[5].collect():
        packed[r["doc_id"]] += r["size"]
    assert packed == words_of
    for r in kept[5].groupBy("bin_id").agg(F.sum("size").alias("s")).collect():
        assert r["s"] <= packing.CAPACITY


def test_pipeline_run_on_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "copy", "piece", "size", "bin_id", "start"] and out.count() > 100


def test_pipeline_on_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, fn in corpus_pipeline.STAGES:
        docs = fn(spark, docs, SF)
    assert docs.count() == 0


def test_operators_that_keep_rows_keep_columns(spark):
    docs = spark.createDataFrame([(*r, "x", 1.5) for r in fixture()], DOCS + ", `__row` string, `__h` double")
    for out in (exact_dedup.drop_exact_duplicates(docs), near_dedup.drop_near_duplicates(docs), mixing.curriculum(docs),
                langid.keep_identified(docs)):
        assert out.columns == docs.columns and {(r["__row"], r["__h"]) for r in out.collect()} == {("x", 1.5)}
