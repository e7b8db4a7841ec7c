"""Exact, near and embedding duplicates against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from helpers_llm import DOCS, components, lower, near_components
from pyspark.sql import functions as F

from fundflow.llm import embed_dedup, exact_dedup, near_dedup
from fundflow.llm.common import bitmap, with_membership
from fundflow.llm.graph import components as spark_components


def words(rnd, n, vocab=4000):
    return [f"w{rnd.randrange(vocab)}" for _ in range(n)]


def edited(rnd, base, share):
    return [f"x{rnd.randrange(10 ** 6)}" if rnd.random() < share else w for w in base]


def test_bitmap_has_no_false_negative(spark):
    keys = spark.range(0, 3000, 7).select(F.xxhash64("id").alias("h"))
    seen = with_membership(spark.range(3000).select("id", F.xxhash64("id").alias("h")), bitmap(keys, "h", 16), "h", "hit", 16)
    got = {r["id"] for r in seen.filter("hit").collect()}
    assert set(range(0, 3000, 7)) <= got and len(got) < 600


def exact_want(rows):
    keys = {}
    for d, t in rows:
        keys.setdefault(lower(t), []).append(d)
    out = []
    for d, t in rows:
        ids = keys[lower(t)]
        known = [x for x in ids if x is not None]
        keep = max(known) if known else None
        out.append((d, keep, len(ids), d == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


LONG = "long " * 40_000
EXACT = [(1, "A b"), (2, "a B"), (3, "a b "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, LONG), (9, LONG + "x"),
         (10, LONG), (11, LONG[:-5] + "gnol "), (12, "same"), (12, "same"), (12, "other"), (None, "same"),
         (None, "alone"), (None, "alone")]


def test_exact_duplicates(spark):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in EXACT],
                                 "doc_id long, text string, group_size int, text_sha256 string")
    full = exact_dedup.exact_duplicates(docs, digest_all=True)
    assert sorted((tuple(r) for r in full.collect()), key=repr) == exact_want(EXACT)
    # Whole texts are hashed only where length and prefix are shared.
    some = {(r["doc_id"], r["text_sha256"] is None) for r in exact_dedup.exact_duplicates(docs).collect()}
    assert (3, True) in some and (9, True) in some and (8, False) in some and (11, False) in some


def test_drop_exact_duplicates(spark):
    docs = spark.createDataFrame([(d, t, f"k{i}", "id") for i, (d, t) in enumerate(EXACT)],
                                 "doc_id long, text string, `__id` string, kept string")
    got = sorted(((r["doc_id"], r["text"]) for r in exact_dedup.drop_exact_duplicates(docs).collect()), key=repr)
    want = sorted({(d, t) for d, t in EXACT if (d, t) in
                   {(2, "a B"), (3, "a b "), (5, ""), (6, "É"), (7, "é"), (9, LONG + "x"), (10, LONG),
                    (11, LONG[:-5] + "gnol "), (12, "same"), (12, "other"), (None, "alone")}}, key=repr)
    assert got == want


def test_exact_duplicates_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"t{i % 50}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in exact_dedup.exact_duplicates(docs, digest_all=True).collect()), key=repr) == exact_want(rows)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    """Copies at all distances of several bases, among unrelated texts; edge cases."""
    rnd = random.Random(width)
    docs, n = [], 100
    for size, copies in ((30, 40), (150, 60), (12, 20)):
        base = words(rnd, size)
        for k in range(copies):
            docs.append((n, " ".join(edited(rnd, base, rnd.choice([0, .01, .02, .04, .06, .1])))))
            n += 1
    docs += [(n + i, " ".join(words(rnd, rnd.randrange(1, 120)))) for i in range(150)]
    docs += [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (7, "A\tB"), (8, "b a"),
             (9, "é\u00a0x y"), (10, "É\u00a0x y"), (11, LONG), (12, LONG + "end"), (13, "a"), (14, "ab")]
    rnd.shuffle(docs)
    frame = spark.createDataFrame([(*d, 0, [1]) for d in docs], "doc_id long, text string, n int, bands array<int>")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(frame, width=width).collect()}
    want = near_components(docs, width)
    assert got == want
    kept = {r["doc_id"] for r in near_dedup.drop_near_duplicates(frame, width=width).collect()}
    assert kept == {d for d, (_, c) in want.items() if c == d}


def test_near_duplicates_chain(spark):
    """A chain whose ends are far apart is one component, through members that no hub links."""
    rnd = random.Random(4)
    now, docs = words(rnd, 200), []
    for i in range(40):
        docs.append((i, " ".join(now)))
        now = [f"c{i}_{j}" if 3 * (i % 60) <= j < 3 * (i % 60) + 6 else w for j, w in enumerate(now)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=2).collect()}
    assert got == near_components(docs, 2)


def test_near_duplicates_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "p q r s t u"), (2, "p q r s t u"), (3, "a b c d e f"), (None, "a b c d e f"), (9, "z")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted(
        [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (None, None, True), (9, 9, True)], key=repr)


def test_drop_near_duplicates_keeps_the_other_text_of_an_id(spark):
    a = " ".join(f"w{i}" for i in range(60))
    near, other = a + " x", " ".join(f"q{i}" for i in range(60))
    rows = [(1, a, 1), (2, near, 2), (2, other, 3), (3, other + " y", 4), (4, "z", 5), (4, "z", 6), (None, a, 7), (None, None, 8),
            (5, "", 9), (5, None, 10), (6, "only one", 11), (6, "and another", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__id` int")
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # 2's copy of 1 goes; 2's other text gives way to 3, whose id stands for one text.
    assert sorted(r["__id"] for r in kept.collect()) == [1, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    alone = spark.createDataFrame([r for r in rows if r[0] != 3], docs.schema)
    assert sorted(r["__id"] for r in near_dedup.drop_near_duplicates(alone).collect()) == [1, 3, 5, 6, 7, 8, 9, 10, 11, 12]


def test_super_minhash_estimates_similarity(monkeypatch):
    rnd = np.random.default_rng(3)
    m = 128
    errors = []
    for _ in range(60):
        a, b, c = (rnd.integers(0, 2 ** 63, k, dtype=np.uint64) for k in (60, 20, 20))
        s = near_dedup.super_minhash([np.unique(np.r_[a, b]), np.unique(np.r_[a, c])], m)
        assert len(np.unique(s[0])) == m  # every slot has its own step and value
        errors.append((s[0] == s[1]).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.02
    # Lower variance than independent hashes would have.
    assert np.var(errors) < 0.6 * 0.4 / m
    # A set larger than a chunk is signed in parts, with the same signature.
    big = np.unique(rnd.integers(0, 2 ** 63, 3 * near_dedup.CHUNK, dtype=np.uint64))
    whole = near_dedup.super_minhash([big], 32)
    monkeypatch.setattr(near_dedup, "CHUNK", 1 << 30)
    assert np.array_equal(near_dedup.super_minhash([big], 32), whole)
    one = near_dedup.super_minhash([np.array([5], np.uint64)], 16)
    assert np.array_equal(np.sort(one[0] >> np.uint64(56)), np.arange(16))


def test_shared_counts():
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 9000, rnd.integers(1, 7000)).astype(np.uint64)) for _ in range(12)]
    got = near_dedup.shared_counts(sets[:5], sets[5:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]


def test_components(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, x) for x in range(1001, 1400)] + \
            [(rnd.randrange(2000, 2400), rnd.randrange(2000, 2400)) for _ in range(350)] + [(5000, 5000), (7, 6)]
    rnd.shuffle(edges)
    got = {r["node"]: r["root"] for r in spark_components(
        spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    nodes = {x for e in edges for x in e}
    want = components(nodes, edges)
    assert got == {n: want[n] for n in nodes if n != 5000}
    assert spark_components(spark.createDataFrame([], "u long, v long")).count() == 0


def embed_want(rows):
    good = {}
    for i, (d, v) in enumerate(rows):
        if d is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[i] = x / np.sqrt(x @ x)
    links = [(i, j) for i in good for j in good if i < j and good[i] @ good[j] >= 0.95]
    n = {i: 0 for i in range(len(rows))}
    for i, j in links:
        n[i] += 1
        n[j] += 1
    return n, links


@pytest.mark.parametrize("block", [16, 4096])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_duplicates(spark, block, kind):
    rnd = np.random.default_rng(block)
    centres = rnd.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rnd.normal(size=8) * rnd.choice([0.02, 0.2, 0.5])).astype(np.float32).tolist())
            for i in range(160)]
    rows += [(160 + i, rows[i % 3][1]) for i in range(30)]  # equal vectors
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [float("nan")] * 8), (304, [1.0] * 7),
             (305, [None] + [1.0] * 7), (306, [float("inf")] + [0.0] * 7), (307, [1e-30] * 8), (308, [1e30] * 8),
             (None, rows[0][1])]
    n, links = embed_want(rows)
    ids = [d for d, _ in rows]
    root = components([d for d in ids if d is not None], [(ids[i], ids[j]) for i, j in links])
    frame = spark.createDataFrame([(d, v, 0, "c") for d, v in rows],
                                  f"vec_id long, embedding array<{kind}>, n_links int, cell string")
    got = sorted((tuple(r) for r in embed_dedup.embedding_duplicates(frame, block=block).collect()), key=repr)
    want = [(d, n[i], root.get(d), d is None or root[d] == d) for i, d in enumerate(ids)]
    assert got == sorted(want, key=repr)


def test_embeddings_of_several_lengths(spark):
    """Every length is compared within itself, as if it were a table of its own."""
    rnd = np.random.default_rng(8)
    rows = []
    for dim, n in ((8, 90), (5, 60), (2, 12), (1, 6)):
        centres = rnd.normal(size=(5, dim))
        rows += [(centres[i % 5] + rnd.normal(size=dim) * rnd.choice([0.02, 0.3])).astype(np.float32).tolist() for i in range(n)]
    rows += [rows[100], rows[100], [3.0] * 40, [3.0] * 40, [1.0] * 33]  # copies: beside others, alone in a length; a single vector
    unit = [np.array(v, float) / np.linalg.norm(v) for v in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             if len(rows[i]) == len(rows[j]) and unit[i] @ unit[j] >= 0.95]
    root, n = components(range(len(rows)), links), [sum(i in x for x in links) for i in range(len(rows))]
    assert all(any(len(rows[i]) == d for i, _ in links) for d in (8, 5, 2, 1, 40))
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in embed_dedup.embedding_duplicates(frame, block=16).collect())
    assert got == [(i, n[i], root[i], root[i] == i) for i in range(len(rows))]
    alone = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [1.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in embed_dedup.embedding_duplicates(alone).collect()) == [
        (1, 0, 1, True), (2, 1, 2, True), (3, 1, 2, False)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_duplicates(docs).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0
    assert near_dedup.drop_near_duplicates(docs).columns == docs.columns
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.embedding_duplicates(vectors).count() == 0
