"""Queries without SQL over whole tables, against plain Python that shares no code with them."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import best_fit, lower, ngrams, words

from fundflow.llm import packing, quality
from fundflow.llm.common import table
from fundflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def ranked(counts, top=400):
    """Most frequent n-grams first; ties by the packed code points."""
    def code(gram):
        x = 0
        for p in gram:
            x = x << 21 | p
        return x
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:top]


def test_language_query_matches_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang").collect()
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1 for d in docs}
    counts = {}
    for d in docs:
        if d["lang"] is not None and d["text"] is not None and not held[d["doc_id"]]:
            counts.setdefault(d["lang"], Counter()).update(ngrams(d["text"]))
    profiles = {lang: {g: i for i, g in enumerate(ranked(c))} for lang, c in counts.items()}
    want = {}
    for d in docs:
        grams = ranked(ngrams(d["text"]))
        if not grams:
            want[d["doc_id"]] = ("und", 0.0)
            continue
        out = {lang: sum(abs(p[g] - i) if g in p else 400 for i, g in enumerate(grams)) for lang, p in profiles.items()}
        lang = min(sorted(out), key=out.get)
        want[d["doc_id"]] = (lang, 1 - out[lang] / (400 * len(grams)))
    got = QUERIES["op1_rank_order_langid"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-12) and r["held_out"] == held[r["doc_id"]]


def test_packing_query_matches_brute_force(spark):
    """At this size all pieces are one group, which plain best fit packs whole."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "source").collect()
    pieces = []
    for d in docs:
        left, k = len(words(d["text"])) + 1, 0
        while left > 0:
            pieces.append((-min(left, packing.CAPACITY), d["doc_id"], k, lower(d["text"]), d["source"]))
            left, k = left - packing.CAPACITY, k + 1
    assert len(pieces) < packing.GROUP_ROWS
    pieces.sort(key=lambda p: p[:3])
    at = best_fit([(-size, text, source) for size, _, _, text, source in pieces], packing.CAPACITY, packing.MAX_PER_SOURCE)
    filled, want = Counter(), {}
    for b, (size, doc, k, _, _) in zip(at, pieces):
        want.setdefault(b, set()).add((doc, k, -size, filled[b]))
        filled[b] -= size
    got = {}
    for r in QUERIES["op9_conflict_packing"](spark, SF).collect():
        got.setdefault(r["bin_id"], set()).add((r["doc_id"], r["piece"], r["size"], r["start"]))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_histogram_splits_are_the_best_of_all():
    """Every node of the first tree against each feature and each cut, sums taken row by row."""
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(1500, 4))
    x[:, 3] = np.round(x[:, 3])  # few values, so fewer cuts than bins
    y = ((x[:, 0] + x[:, 1] * x[:, 3] > 0.2) ^ (rnd.random(1500) < 0.1)).astype(float)
    trees = quality.fit(x, y, trees=1, depth=3)
    p = (y.sum() + 0.5) / (len(y) + 1.0)
    g, h = p - y, np.full(len(y), p * (1 - p))

    def gain(rows, left):
        parts = [(g[m].sum(), h[m].sum()) for m in (rows & left, rows & ~left, rows)]
        if min(parts[0][1], parts[1][1]) < quality.MIN_HESSIAN:
            return 0.0
        return sum(s * a * a / (b + quality.RIDGE) for s, (a, b) in zip((1, 1, -1), parts))

    at = {0: np.ones(len(y), bool)}
    for i in range(7):
        rows = at[i]
        best = max(gain(rows, x[:, f] <= c) for f in range(4)
                   for c in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS + 1)[1:-1])))
        f, c = trees.feature[0, i], trees.cut[0, i]
        left = x[:, f] <= c
        assert (gain(rows, left) if np.isfinite(c) else 0.0) == pytest.approx(best, abs=1e-9)
        at[2 * i + 1], at[2 * i + 2] = rows & left, rows & ~left
    for j in range(8):
        rows = at[7 + j]
        assert trees.value[0, j] == pytest.approx(-quality.RATE * g[rows].sum() / (h[rows].sum() + quality.RIDGE))


def test_quality_query_never_reads_held_out_labels(spark, scratch):
    """Turning every held-out label over changes no score."""
    for name in ("documents", "labels"):
        df = table(spark, SF, name)
        if name == "labels":
            df = df.selectExpr(
                *[c for c in df.columns if c != "quality"],
                "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
        df.write.parquet(f"{scratch}/{name}.parquet")
    scores = [{r["doc_id"]: (r["held_out"], r["score"], r["predicted"]) for r in QUERIES["op7_boosted_quality"](spark, d).collect()}
              for d in (SF, scratch)]
    assert scores[0] == scores[1] and any(h for h, _, _ in scores[0].values())
