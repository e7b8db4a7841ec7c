"""A training-data pipeline of five operators over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's documents.  Every stage works on all that
its predecessor kept, and defines its result for NULLs, empty and repeated
rows and empty tables as its operator does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundflow.llm import exact_dedup, langid, mixing, near_dedup, packing
from fundflow.operators.stage import stage


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; a missing language is filled in."""
    return langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at similarity 0.8 on five-word shingles, the one
    with the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in training order: a document the mix
    takes more than once has as many rows, one it does not take has none."""
    return mixing.curriculum(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's documents packed into sequences: one row per piece."""
    return packing.pack(docs)


STAGES = [("language_id", identify), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pack", pack)]

#: Rank-order profiles, signatures and packing have no SQL form: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
