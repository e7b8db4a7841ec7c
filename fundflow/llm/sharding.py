"""Sharding by proportional stratified interleaving.

Rows of each source are put into a seeded random order and given the
fractional rank ``(rank + 1/2) / rows of the source``.  Sorting all rows by
fractional rank interleaves the sources in proportion, and equal cuts of that
order give shards whose sizes in rows differ by one at most and whose mixture
is the corpus's (law ``rows``).  Both ranks are two-level running counts
(:func:`fundflow.llm.common.running`): no source and no shard is sorted in one
task, and only ids, sizes and hashes are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import bucket_count, group_key, running, whole_row
from fundflow.operators.stage import stage

SEED = 20_240_901


def shard_rows(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", seed: int = SEED, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``; ``shard`` runs from 0, ``slot`` is gapless from 0 in it.
    ``row_col`` names a column that tells all rows apart: it is returned too,
    and spreads rows that repeat id and text over the shards' order.

    ``size`` is the UTF-8 bytes of the text plus 1 (NULL text: 1), a NULL
    source is a source of its own.  Ties (repeated rows) are ordered by id,
    then CRC; rows equal in all of these are interchangeable.  Fewer rows
    than shards leave the last shards empty; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), group_key(F.col(source_col)).alias("__src"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), *([F.col(row_col)] if row_col else []))
    own = [row_col] if row_col else []
    # The CRC in the hash keeps rows that repeat an id apart.
    rows = stage(rows.withColumn("__h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size", *own)), "shard-rows")
    total = rows.count()
    n = bucket_count(total)
    # Top bits of the hash: rises with it, so buckets are in hash order.
    rows = rows.withColumn("__b", F.floor((F.col("__h") / 2.0 ** 64 + 0.5) * n).cast("int"))
    sizes = rows.groupBy("__src").agg(F.count(F.lit(1)).alias("__rows"))
    ranked = running(rows, ["__src"], "__b", ["__h", "doc_id", "text_crc32", *own], F.lit(1), "__rank", sizes)
    # Fractional rank as an exact rational's double: the same on every run.
    ranked = ranked.withColumn("__frac", (F.col("__rank") * 2 + 1) / (F.col("__rows") * 2.0))
    ranked = stage(ranked.withColumn("__fb", F.least(F.floor(F.col("__frac") * n), F.lit(n - 1)).cast("int"))
                   .select("doc_id", "size", "text_crc32", "__src", "__h", "__frac", "__fb", *own), "shard-ranks")
    place = running(ranked, [], "__fb", ["__frac", "__src", "__h", "doc_id", "text_crc32", *own], F.lit(1), "__g")
    # Integer division, exact for any row count below 2^63 / shards.
    shard = F.expr(f"(__g * {n_shards}L) div {max(total, 1)}L")
    first = F.expr(f"(__s * {total}L + {n_shards - 1}L) div {n_shards}L")
    return (place.withColumn("__s", shard).withColumn("__first", first)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("__s").cast("int").alias("shard"),
                    (F.col("__g") - F.col("__first")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), *own))


def write_shards(docs: DataFrame, path: str, n_shards: int, id_col: str = "doc_id", **kw) -> None:
    """Write ``docs`` as Parquet folders ``shard=0 .. n-1`` under ``path``, each
    sorted by slot inside its files; their columns are those of ``docs`` and
    ``slot`` (a column of ``docs`` named ``shard`` or ``slot`` is replaced).
    Every row is written once, NULL and repeated ids included: rows are
    numbered in a written copy and carry their number to their place."""
    rows = stage(docs.select(whole_row(docs), F.monotonically_increasing_id().alias("__number")), "shard-numbered")
    flat = rows.select("__number", *[F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c != "__number"])
    at = shard_rows(flat, n_shards, id_col, row_col="__number", **kw).select("__number", "shard", "slot")
    kept = [F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]
    (rows.join(at, "__number").select(*kept, "shard", "slot")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
