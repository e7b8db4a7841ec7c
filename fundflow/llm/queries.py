"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.llm import (alignment, chat, embed_dedup, exact_dedup, langid, mixing, near_dedup, oracle, packing, pii,
                          quality, sharding, url_reputation, whitening)
from fundflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return add


# --- 1 -----------------------------------------------------------------------

@query()
def op1_rank_order_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


# --- 2 -----------------------------------------------------------------------

@query(oracle.URLS)
def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of a page: the quality label of the document it shows, whose
    number its path names."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    shown = pages.select("page_id", url_reputation.shown_document(F.col("url")).alias("doc_id")).filter("doc_id IS NOT NULL")
    good = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("good"))
    return url_reputation.judge_urls(pages, shown.join(good, "doc_id").select("page_id", "good"))


# --- 3 -----------------------------------------------------------------------

@query("""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


# --- 4 -----------------------------------------------------------------------

@query(oracle.NEAR)
def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


# --- 5 -----------------------------------------------------------------------

MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
           FROM documents),
h AS (SELECT *, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h FROM d),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w,
         ((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 + 1 AS tilt, source_size * 3.0::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, row_number() OVER o AS i,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
       FROM s1 WINDOW o AS (ORDER BY cap / w, coalesce('=' || source, '~'))),
s3 AS (SELECT *, min(CASE WHEN cap >= w * level THEN i END) OVER () AS f FROM s2),
s4 AS (SELECT source, source_size, [1.4, 1.0, 0.6][tilt]::DOUBLE AS a, [0.6, 1.0, 1.4][tilt]::DOUBLE AS b,
         CASE WHEN i < coalesce(f, 1e18) THEN cap ELSE w * max(CASE WHEN i = f THEN level END) OVER () END AS target
       FROM s3),
c AS (SELECT h.doc_id, h.size, s4.source_size, s4.target, s4.a, s4.b, CAST(floor(s4.target + 0.5) AS BIGINT) AS due,
        CAST(coalesce(sum(h.size) OVER (PARTITION BY h.source ORDER BY h.h
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS c
      FROM h JOIN s4 ON h.source IS NOT DISTINCT FROM s4.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(greatest(least(due - c, size), 0) + greatest(least(due - c - source_size, size), 0)
       + greatest(least(due - c - 2 * source_size, size), 0) AS BIGINT) AS taken,
  -- Weight falls or rises from a to b over time t in 0..1: a t + (b - a) t^2 / 2 = share (a + b) / 2.
  CASE WHEN least(due - c, size) > 0 THEN round(least((a + b) * (c / target) / (a + sqrt(greatest(
    a * a + (b - a) * (a + b) * (c / target), 0))), 1), 6) END AS position
FROM c"""


@query(MIX_SQL)
def op5_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In training order of a document's first copy, whose training time is
    ``position``; documents not taken (NULL) last."""
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    first = F.get("copies", 0)["position"]
    return (plan.withColumn("__at", F.coalesce(first, F.lit(2.0)))
            .repartitionByRange("__at", "doc_id").sortWithinPartitions("__at", "doc_id")
            .select("doc_id", "size", "source_size", "target", "taken", F.round(first, 6).alias("position")))


# --- 6 -----------------------------------------------------------------------

@query(oracle.EMBEDDINGS)
def op6_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_duplicates(table(spark, sf_dir, "embeddings"))


# --- 7 -----------------------------------------------------------------------

@query()
def op7_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- 8 -----------------------------------------------------------------------

@query()
def op8_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), 8)


# --- 9 -----------------------------------------------------------------------

@query()
def op9_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


# --- 10 ----------------------------------------------------------------------

PROBE = "</s>[INST] ok [/INST]"


def _chat_sql() -> str:
    """Control strings are found with RE2, so the escape is written with groups."""
    quote = lambda s: "".join("\\" + ch if not ch.isalnum() else ch for ch in s)
    marks = "|".join(f"{quote(c[0])}{chat.JOINER}*{quote(c[1:])}" for c in chat.CONTROL)
    escaped = lambda c: f"regexp_replace({c}, '({marks})', chr(1) || '\\1', 'g')"
    added = len(chat.START + chat.TEXT + chat.END)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, t, r, '{PROBE}' FROM (VALUES (0, 'user'), (1, 'assistant')) x(t, r))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({added} + length({escaped('role')}) + length({escaped('text')})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


@query(_chat_sql())
def op10_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every figure is read back from the formatted string and the loss spans."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    out = chat.format_chats(rows.unionByName(probe).select("conv_id", "turn", "role",
                                                          chat.text_parts(F.col("text")).alias("parts")))
    out = out.withColumn("turns", chat.read_turns(F.col("formatted")))
    out = out.withColumn("loss", chat.read_loss(F.col("turns"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), chat.unescape(t["content"]),
                                                                F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


# --- 11 ----------------------------------------------------------------------

#: Vocabulary files, read on the driver.
VOCAB_A, VOCAB_B, VOCAB_B_SIZE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model", 32_000


@query()
def op11_lockstep_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups are hashed before anything is written."""
    aligned = alignment.align(table(spark, sf_dir, "documents"), VOCAB_A, VOCAB_B)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return alignment.with_counts(aligned.withColumn("groups_sha256", digest).drop("groups"), VOCAB_B_SIZE)


# --- 12 ----------------------------------------------------------------------

@query()
def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


# --- 13 ----------------------------------------------------------------------

@query()
def op13_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers and the digest are of the rules' spans."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, pii.KINDS),
                        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))
