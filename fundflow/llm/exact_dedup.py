"""Exact duplicates by progressive refinement (native).

Three rounds narrow the rows that can have a copy, each with a longer key:

1. the length of the normalised text in bytes,
2. length and a hash of the first ``prefix_chars`` characters,
3. length, prefix hash and SHA-256 of the whole text, computed only for rows
   whose (length, prefix) is shared.

Length and prefix come from one scan and are counted per (length, prefix), so
a group that holds a third of all rows is one row per task before the
shuffle.  The keys that survive a round go into a bitmap of fixed size, which
is broadcast; the scan that takes the full hashes tests it row by row, so no
text is ever shuffled and a false positive only costs one more hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import ascii_lower, bitmap, group_key, whole_row, with_membership
from fundflow.operators.stage import stage

PREFIX_CHARS = 64


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; NULL counts as
    empty.  ``keep_id`` is the largest id of the group, ``group_size`` its
    rows.  ``text_sha256`` is NULL for rows that a shorter key already told
    apart, unless ``digest_all`` asks for every digest.  A NULL id never wins
    against another; a group of NULL ids only has ``keep_id`` NULL and keeps
    all its rows.  Rows that repeat an id and a text are one document: they
    share the verdict.  Other columns are ignored.  An empty table gives an
    empty result.
    """
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = (docs.select(F.col(id_col).alias("doc_id"), norm.alias("__text"))
            .select("doc_id", "__text", F.octet_length("__text").alias("__len"),
                    F.xxhash64(F.substring("__text", 1, prefix_chars)).alias("__prefix")))
    keys = stage(rows.groupBy("__len", "__prefix").agg(F.count(F.lit(1)).alias("__n")), "exact-keys")
    # Round 1: lengths that more than one row has.
    by_len = keys.groupBy("__len").agg(F.sum("__n").alias("__n")).filter("__n > 1")
    round1 = with_membership(keys.withColumn("__h", F.xxhash64("__len")),
                             bitmap(by_len.select(F.xxhash64("__len").alias("__h")), "__h"), "__h", "__in")
    # Round 2: of those, (length, prefix) pairs that more than one row has.
    round2 = round1.filter("__in AND __n > 1").select(F.xxhash64("__len", "__prefix").alias("__h"))
    rows = with_membership(rows.withColumn("__h", F.xxhash64("__len", "__prefix")), bitmap(round2, "__h"),
                           "__h", "__in")
    # Round 3: the whole text, only where the shorter keys agree.
    full = F.sha2(F.col("__text").cast("binary"), 256)
    rows = rows.select("doc_id", "__len", "__prefix", F.when(F.col("__in"), full).alias("__full"),
                       (full if digest_all else F.when(F.col("__in"), full)).alias("text_sha256"))
    key = ["__len", "__prefix", "__fk"]
    rows = stage(rows.withColumn("__fk", F.coalesce("__full", F.lit(""))).drop("__full"), "exact-rows")
    groups = (rows.groupBy(*key)
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"))
    # Read back, the groups are a plain join's other side: adaptive execution splits the rows of a hot one.
    rows = rows.join(stage(groups, "exact-groups"), key, "left")
    alone = F.col("group_size").isNull()
    return (rows.withColumn("keep_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")))
            .select("doc_id", "keep_id", F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``docs``, all columns, with one row of every group of equal texts: the
    one with the largest id, once where that id and text repeat.

    Rows that cannot be concerned (by a bitmap of the ids concerned) pass
    straight through; only the others are joined, so untouched texts are not
    shuffled.  The key is id and digest: an id that also stands for another
    text keeps that text.
    """
    verdicts = stage(exact_duplicates(docs, id_col, text_col, prefix_chars).filter("group_size > 1")
                     .groupBy(group_key(F.col("doc_id")).alias("__id"), F.col("text_sha256").alias("__sha"))
                     .agg(F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("__n"))
                     .filter("NOT __kept OR __n > 1"), "exact-verdicts")
    rows = docs.select(whole_row(docs), group_key(F.col(id_col)).alias("__id")).withColumn("__h", F.xxhash64("__id"))
    sha = F.sha2(ascii_lower(F.coalesce(F.col(f"__row.{text_col}"), F.lit(""))).cast("binary"), 256)
    flagged = with_membership(rows, bitmap(verdicts.select(F.xxhash64("__id").alias("__h")), "__h"), "__h", "__in")
    concerned = (flagged.filter("__in").withColumn("__sha", sha)
                 .join(verdicts.filter("NOT __kept").select("__id", "__sha"), ["__id", "__sha"], "left_anti")
                 .dropDuplicates(["__id", "__sha"]))
    return flagged.filter("NOT __in").select("__row.*").union(concerned.select("__row.*"))
