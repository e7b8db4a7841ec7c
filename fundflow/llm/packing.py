"""Conflict-constrained best-fit packing of documents into sequences.

A document takes its words and one separator.  What exceeds a sequence is cut
into full pieces, which fill bins of their own, and a rest.  All pieces are
dealt by hash into groups of about ``GROUP_ROWS``; each group is packed on its own, so packing is parallel and a group is bounded
whatever the input.  Only ids and sizes are shuffled.

In a group, pieces go in falling size.  Open bins are kept in order of their
residual space; from the tightest bin that has room the search goes on to the
next until one is compatible, else a new bin is opened.  A bin carries one
bitmap of duplicate clusters and ``max_per_source`` bitmaps of sources (the
k-th has the bit of a source that occurs at least k times): a piece conflicts
with a bin that has its cluster, or its source in the last bitmap.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import ascii_lower, group_key, word_count
from fundflow.operators.stage import stage

CAPACITY = 2048
GROUP_ROWS = 4096
MAX_PER_SOURCE = 4


def best_fit(sizes: list[int], clusters: list, sources: list, capacity: int,
             max_per_source: int = MAX_PER_SOURCE) -> list[int]:
    """Bin of every piece, in the order given.  Each size is at most ``capacity``."""
    bit: dict = {}
    of = lambda kind, key: bit.setdefault(kind, {}).setdefault(key, len(bit[kind]))
    count: dict = {}
    for c in clusters:
        count[c] = count.get(c, 0) + 1
    have: list[int] = []  # clusters of each bin
    planes: list[list[int]] = []  # sources of each bin, by occurrence
    residual_order: list[tuple[int, int]] = []
    out = []
    for size, cluster, source in zip(sizes, clusters, sources):
        # A cluster of one piece conflicts with nothing and needs no bit.
        c = 1 << of("c", cluster) if count[cluster] > 1 else 0
        s = 1 << of("s", source)
        i = bisect_left(residual_order, (size, -1))
        while i < len(residual_order):
            b = residual_order[i][1]
            if not (have[b] & c or planes[b][-1] & s):
                break
            i += 1
        if i < len(residual_order):
            left = residual_order.pop(i)[0] - size
        else:
            b, left = len(have), capacity - size
            have.append(0)
            planes.append([0] * max_per_source)
        have[b] |= c
        for k, plane in enumerate(planes[b]):
            if not plane & s:
                planes[b][k] |= s
                break
        if left:
            insort(residual_order, (left, b))
        out.append(b)
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, max_per_source: int = MAX_PER_SOURCE, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: ``doc_id, copy, piece, size, bin_id, start``.

    ``copy`` numbers rows that repeat id, text and source from 0, ``piece`` a
    document's pieces from 0, ``start`` is the place in the bin.  The cluster
    of a document is its text with A-Z lower-cased, so no bin holds two copies
    of a text, nor more than ``max_per_source`` pieces of a source (full
    pieces are alone in any case).  NULL and empty texts take one separator
    and are one cluster; a NULL source is a source of its own; an empty table
    gives no rows.  Ties are broken by id, so the same rows give the same bins.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), group_key(F.col(source_col)).alias("source"),
                       (word_count(text) + 1).alias("words"), F.xxhash64(ascii_lower(text)).alias("cluster"))
    # Repeated rows are counted before the shuffle, then numbered.
    rows = (rows.groupBy("doc_id", "source", "words", "cluster").agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))))
    pieces = rows.withColumn("piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(words - 1) div {capacity}"))))
    size = F.least(F.col("words") - F.col("piece") * capacity, F.lit(capacity)).cast("long")
    pieces = stage(pieces.withColumn("size", size).select("doc_id", "copy", "piece", "size", "source", "cluster"),
                   "pack-pieces")
    groups = max(1, -(-pieces.count() // group_rows))
    # pandas has no NULL in a long column: send a flag beside the id.
    dealt = (pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "copy", "piece", "cluster"), F.lit(groups)).cast("long"))
             .withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast("long"))))

    def pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "no_id", "cluster", "copy", "piece"],
                              ascending=[False, True, True, True, True, True]).reset_index(drop=True)
        pdf["bin"] = best_fit(pdf["size"].tolist(), pdf["cluster"].tolist(), pdf["source"].tolist(), capacity,
                              max_per_source)
        pdf["start"] = pdf.groupby("bin")["size"].cumsum() - pdf["size"]
        pdf["bin_id"] = pdf["g"] * (1 << 32) + pdf["bin"]
        return pdf[["doc_id", "no_id", "copy", "piece", "size", "bin_id", "start"]]

    packed = dealt.groupBy("g").applyInPandas(
        pack_group, "doc_id long, no_id boolean, copy long, piece long, size long, bin_id long, start long")
    return packed.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "copy", "piece", "size", "bin_id",
                         "start")
