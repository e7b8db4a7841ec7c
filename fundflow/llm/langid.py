"""Language ID by rank-order n-gram profiles.

A language's profile is its most frequent letter n-grams (1 to 3 letters,
words padded with blanks) in order of frequency.  A document's own most
frequent n-grams are ranked alike; the distance to a language is the sum over
them of how far out of place each is in the profile, ``TOP`` where it is
missing.  The nearest profile wins.

Profiles are counted by Spark over a bounded sample of labelled documents and
are small by construction (``MAX_LANGUAGES`` x ``TOP`` entries).  Whole texts
are ranked in Arrow batches; nothing of a document leaves its task but the
verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundflow.llm.common import whole_row

#: N-grams in a profile, of a language and of a document.
TOP = 400
#: Bounds of the training sample: documents per language, and languages (the most frequent).
MAX_TRAIN_DOCS = 1000
MAX_LANGUAGES = 500
UNKNOWN = "und"


class NgramCounter:
    """N-gram codes of texts.  An n-gram's code packs its code points, 21 bits
    each, so codes are exact and ordered."""

    def __init__(self) -> None:
        #: Which code points of the basic plane are letters.
        self.letters = np.array([chr(i).isalpha() for i in range(1 << 16)])

    def is_letter(self, points: np.ndarray) -> np.ndarray:
        out = self.letters[np.minimum(points, 0xFFFF)]
        high = points > 0xFFFF
        if high.any():
            out[high] = [chr(x).isalpha() for x in points[high]]
        return out

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct codes, ascending, and how often each occurs in the whole
        text.  Runs of letters are padded with one blank on either side."""
        points = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le"), "<u4").astype(np.int64)
        letter = self.is_letter(points)
        if not letter.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        points[~letter] = 32
        keep = np.ones(len(points), bool)  # the first blank, letters, and the blank behind each run
        keep[1:] = letter[1:] | letter[:-1]
        x, inner = points[keep], letter[keep]
        codes = [x[inner], (x[:-1] << 21) | x[1:],
                 ((x[:-2] << 42) | (x[1:-1] << 21) | x[2:])[inner[1:-1]]]
        return np.unique(np.concatenate(codes), return_counts=True)


def top_ranked(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    return codes[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    """Rank matrix of all languages over the n-grams of any profile."""

    def __init__(self, ranked: dict[str, list[int]], top: int = TOP) -> None:
        self.langs = sorted(ranked)
        self.top = top
        self.vocab = np.unique(np.concatenate([np.asarray(v, np.int64) for v in ranked.values()] or
                                              [np.empty(0, np.int64)]))
        self.ranks = np.full((len(self.langs), len(self.vocab) + 1), -1, np.int64)  # last column: in no profile
        for i, lang in enumerate(self.langs):
            codes = np.asarray(ranked[lang], np.int64)
            self.ranks[i, np.searchsorted(self.vocab, codes)] = np.arange(len(codes))

    def nearest(self, doc: np.ndarray) -> tuple[str, float]:
        """Language with the least out-of-place distance (ties: by name), and
        1 minus that distance over the largest possible one."""
        if not len(doc) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.vocab, doc)
        at[at == len(self.vocab)] = 0
        at = np.where(self.vocab[at] == doc, at, len(self.vocab)) if len(self.vocab) else np.zeros_like(at)
        ranks = self.ranks[:, at]
        out = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(doc)))).sum(axis=1)
        best = int(np.argmin(out))
        return self.langs[best], 1.0 - float(out[best]) / (self.top * len(doc))


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counter = NgramCounter()
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            counts = [counter.count(t) for t in texts]
            codes, at = np.unique(np.concatenate([c for c, _ in counts]), return_inverse=True)
            yield pd.DataFrame({"lang": lang, "code": codes,
                                "n": np.bincount(at, weights=np.concatenate([n for _, n in counts]),
                                                 minlength=len(codes)).astype(np.int64)})


def learn_profiles(train: DataFrame, top: int = TOP, max_docs: int = MAX_TRAIN_DOCS,
                   max_languages: int = MAX_LANGUAGES) -> Profiles:
    """Profiles from ``train (doc_id, text, lang)``: at most ``max_docs``
    documents of each of at most ``max_languages`` languages (the most
    frequent; a language beyond them is never predicted), those whose hashed
    id and text come first.  Rows that repeat both count once, rows with a
    NULL text or lang are not used."""
    train = train.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text")
    train = train.withColumn("__h", F.xxhash64(F.lit("langid"), "doc_id", "text"))
    sizes = (train.groupBy("lang", "__h").agg(F.lit(1).alias("__one")).groupBy("lang").agg(F.count("__one").alias("__n"))
             .orderBy(F.desc("__n"), "lang").limit(max_languages))
    # A first cut by hash leaves about twice the bound, so that the exact cut sorts few rows.
    few = (train.join(F.broadcast(sizes), "lang")
           .filter(F.col("__h") / 2.0 ** 64 + 0.5 <= F.lit(2.0 * max_docs) / F.col("__n") + 16.0 / F.col("__n"))
           .dropDuplicates(["lang", "__h"]))
    w = Window.partitionBy("lang").orderBy("__h", "doc_id", "text")
    sample = few.withColumn("__i", F.row_number().over(w)).filter(F.col("__i") <= max_docs)
    counts = (sample.select("lang", "text").mapInPandas(_count_batches, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = (counts.withColumn("__r", F.row_number().over(rank)).filter(F.col("__r") <= top)
            .select("lang", "code", "__r").collect())  # at most max_languages x top
    ranked: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["__r"])):
        ranked.setdefault(r["lang"], []).append(r["code"])
    return Profiles(ranked, top)


def language_of(text: Column, profiles: Profiles) -> Column:
    """``struct<lang: string, score: double, letters: boolean>`` of a whole
    text; NULL texts and texts without a letter are ``und`` with score 0 and
    ``letters`` false.  Without profiles every text is ``und`` with score 0."""
    @F.arrow_udf("lang string, score double, letters boolean")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = NgramCounter()
        for texts in batches:  # one text at a time leaves the Arrow buffer
            found = []
            for t in texts:
                doc = top_ranked(*counter.count(t.as_py()), profiles.top)
                found.append((*profiles.nearest(doc), len(doc) > 0))
            yield pa.StructArray.from_arrays([pa.array([x for x, _, _ in found], pa.string()),
                                              pa.array([x for _, x, _ in found], pa.float64()),
                                              pa.array([x for _, _, x in found], pa.bool_())],
                                             ["lang", "score", "letters"])

    # Else a filter on the verdict would have every text judged twice.
    return nearest.asNondeterministic()(text)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; NULL ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify_languages(docs: DataFrame, folds: int = 3, fold: int = 1, **bounds: int) -> DataFrame:
    """One row per row of ``docs (doc_id, text, lang)``: ``doc_id, held_out,
    lang_pred, score``.  Profiles come from labelled rows outside the held-out
    fold; rows with a NULL id are never learned from.  Repeated rows are
    judged alike; without any labelled row all are ``und``."""
    out = held_out(F.col("doc_id"), folds, fold)
    profiles = learn_profiles(docs.filter(F.col("doc_id").isNotNull() & ~out), **bounds)
    return (docs.select("doc_id", out.alias("held_out"), language_of(F.col("text"), profiles).alias("__x"))
            .select("doc_id", "held_out", F.col("__x.lang").alias("lang_pred"), F.col("__x.score").alias("score")))


def keep_identified(docs: DataFrame, **bounds: int) -> DataFrame:
    """``docs``, all columns, without documents whose text is NULL or has no
    letter; nothing else is dropped.  Distance and score decide no row, a
    labelled row keeps its ``lang`` whatever its text, and a label that reads
    ``und`` is a language like any other.  A NULL ``lang`` is filled in with
    the nearest language; where no row has both text and ``lang`` nothing can
    be learned, and it stays NULL."""
    profiles = learn_profiles(docs, **bounds)
    named = docs.select(whole_row(docs)).select("__row", language_of(F.col("__row.text"), profiles).alias("__x"))
    found = F.col("__x.lang") if profiles.langs else F.lit(None).cast("string")
    filled = F.col("__row").withField("lang", F.coalesce("__row.lang", found))
    return named.filter("__x.letters").select(filled.alias("__row")).select("__row.*")
