"""Quality classifier: histogram gradient-boosted trees over document
statistics.

Statistics of whole texts are taken in Arrow batches.  The trees are fitted
with logistic loss on a bounded sample of labelled rows (``MAX_TRAIN_ROWS``
rows of ``len(FEATURES)`` numbers): each feature is cut into at most ``BINS``
quantile bins, and a node's best split is read off per-bin sums of gradients
and hessians.  Fitted trees are complete binary trees in flat arrays, which a
batch walks all at once, level by level.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.llm.langid import held_out

MAX_TRAIN_ROWS = 20_000
BINS = 32
TREES = 60
DEPTH = 4
RATE = 0.2
MIN_HESSIAN = 2.0
RIDGE = 1.0
CUT = 0.7

FEATURES = ("log_bytes", "log_words", "log_lines", "mean_word", "longest_word", "upper", "digits", "punctuation",
            "blanks", "non_ascii", "distinct_words", "top_word", "distinct_lines", "mean_line", "short_lines",
            "symbol_words", "stop_marks", "byte_entropy", "distinct_pairs", "one_letter_words")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def statistics(text: str | None) -> list[float]:
    """The :data:`FEATURES` of a whole text; NULL counts as empty."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * len(FEATURES)
    n = len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.lower().split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = seen[seen > 0] / n
    w, k = max(len(words), 1), max(len(lines), 1)
    counts = Counter(words)
    ends = Counter(x[-1] for x in words)
    letters = seen[_UPPER].sum() + seen[97:123].sum()
    return [
        math.log1p(n), math.log1p(len(words)), math.log1p(len(lines)),
        sum(map(len, words)) / w, float(max(map(len, words), default=0)),
        float(seen[_UPPER].sum() / max(letters, 1)), float(seen[_DIGIT].sum() / n), float(seen[_PUNCT].sum() / n),
        float(seen[_BLANK].sum() / n), float(seen[128:].sum() / n),
        len(counts) / w, max(counts.values(), default=0) / w,
        len(set(lines)) / k, n / k, sum(len(x) < 30 for x in lines) / k,
        sum(v for c, v in ends.items() if c < 128 and _PUNCT[c] and c not in b".,;:") / w,
        (ends[46] + ends[33] + ends[63]) / w,
        float(-(share * np.log2(share)).sum()),
        len(set(zip(words, words[1:]))) / max(len(words) - 1, 1),
        sum(len(x) == 1 for x in words) / w,
    ]


def statistics_of(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return stats(text)


@dataclass(frozen=True)
class Trees:
    """``feature[t, i]`` and ``cut[t, i]`` of node i of tree t (children 2i+1
    for values up to the cut, 2i+2 above), ``value[t, j]`` of leaf j."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        if not trees or not len(x):
            return np.full(len(x), 1.0 / (1.0 + math.exp(-self.base)))
        t = np.arange(trees)
        node = np.zeros((len(x), trees), np.int64)
        row = np.arange(len(x))[:, None]
        while node[0, 0] < inner:  # all leaves are on one level
            node = 2 * node + 1 + (x[row, self.feature[t, node]] > self.cut[t, node])
        return 1.0 / (1.0 + np.exp(-(self.base + self.value[t, node - inner].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
        bins: int = BINS) -> Trees:
    """Boosted trees for 0/1 labels.  Without rows, or with one class only,
    the score is the share of 1 (0.5 without rows), kept off 0 and 1."""
    n, features = x.shape
    p = (y.sum() + 0.5) / (n + 1.0)
    base = math.log(p / (1.0 - p))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(features)], axis=1)
    slot = binned + np.arange(features) * bins
    feature, cut, value = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                           np.zeros((trees, leaves)))
    margin = np.full(n, base)
    for t in range(trees):
        prob = 1.0 / (1.0 + np.exp(-margin))
        g, h = prob - y, prob * (1.0 - prob)
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            width, first = 2 ** level, 2 ** level - 1
            at = (node[:, None] * (features * bins) + slot).ravel()
            hist = lambda v: np.bincount(at, np.repeat(v, features), width * features * bins).reshape(
                width, features, bins).cumsum(axis=2)
            left_g, left_h = hist(g), hist(h)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE) - all_g ** 2 / (all_h + RIDGE)
            gain[(left_h < MIN_HESSIAN) | (right_h < MIN_HESSIAN)] = 0.0
            best = gain.reshape(width, -1).argmax(axis=1)
            f, b = best // bins, best % bins
            split = (gain.reshape(width, -1)[np.arange(width), best] > 1e-9) & (b < [len(cuts[i]) for i in f])
            feature[t, first:first + width] = f
            cut[t, first:first + width] = [cuts[i][j] if s else np.inf for i, j, s in zip(f, b, split)]
            last = np.where(split, b, bins)
            node = 2 * node + (binned[np.arange(n), f[node]] > last[node])
        leaf_g, leaf_h = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        value[t] = -rate * leaf_g / (leaf_h + RIDGE)
        margin += value[t, node]
    return Trees(base, feature, cut, value)


def learn_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Trees:
    """Fit on at most ``max_rows`` of ``labels (doc_id, quality)``, those whose
    hashed ids come first.  An id labelled more than once counts once, as 1 if
    any label says so; NULL ids and labels are not used, nor is an id without
    a document."""
    rows = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy("doc_id").agg(F.max("quality").alias("quality"))
            .orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(max_rows))
    # At most max_rows ids: broadcast, so that texts stay where they are.
    stats = (docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
             .select("doc_id", "quality", statistics_of(F.col("text")).alias("x"))
             .groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("x").alias("x"))
             .orderBy("doc_id").collect())
    x = np.array([r["x"] for r in stats], float).reshape(len(stats), len(FEATURES))
    return fit(x, np.array([r["quality"] for r in stats], float))


def quality_of(text: Column, trees: Trees) -> Column:
    """Score of a whole text, 0 to 1."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:  # one text at a time leaves the Arrow buffer
            x = np.array([statistics(t.as_py()) for t in texts], float).reshape(len(texts), len(FEATURES))
            yield pa.array(trees.score(x), pa.float64())

    return score(text)


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, cut: float = CUT,
                  max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: ``doc_id, held_out, score,
    predicted``.  Labels of the held-out fold are never read.  Empty and NULL
    texts are scored by their (zero) statistics; repeated rows alike."""
    out = held_out(F.col("doc_id"), folds, fold)
    trees = learn_quality(docs, labels.filter(~out), max_rows)
    return (docs.select("doc_id", out.alias("held_out"), quality_of(F.col("text"), trees).alias("score"))
            .withColumn("predicted", (F.col("score") >= cut).cast("int")))
