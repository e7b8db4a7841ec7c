"""Incremental landing: pick up only the period files that arrived since
the last run.

The source re-reads every file of a feed folder each quarter.  As a
Structured Streaming job with an ``availableNow`` trigger, each run takes
the files not yet recorded in its checkpoint, tags them with their period
(file name up to the first ``_``), cleans the headers and appends them to
a Parquet table partitioned by period -- exactly once, because the file
sink commits through the same checkpoint.  Downstream batch steps then
read the table and prune to the periods they need.

A file is taken once: one delivered again under its old name is not read a
second time.  For feeds whose files are corrected or withdrawn use
:func:`fundflow.sources.sync_landing`, which compares each file with a manifest
and replaces the rows of changed ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from fundflow.functions.text import period_from_filename
from fundflow.operators.stage import shared_dir
from fundflow.sources.headers import clean_names, normalize_headers
from fundflow.sources.landing import CSV_READ, RAGGED, SOURCE_FILE, reject_ragged_rows, source_name, tag_period


def ingest_new_period_files(
    spark: SparkSession,
    landing_folder: str,
    table_path: str,
    schema: StructType,
    name: str,
    fmt: str = "parquet",
    pattern: str = "FY*",
    checkpoint: str | None = None,
    max_files_per_batch: int | None = None,
    multi_line: bool = False,
) -> int:
    """Append the not-yet-ingested period files of ``landing_folder`` to
    ``table_path``; returns the number of rows appended by this run.

    ``schema`` is the landed files' schema (streaming sources do not
    infer); CSV files must share one header layout, Parquet files are read
    by column name.  As in the batch scan, a CSV row with more or fewer cells
    than its header stops the run, and ``multi_line`` allows line breaks in
    quoted cells (one task a file).
    """
    ckpt = checkpoint or f"{shared_dir(spark)}/fundflow-stream/{name}"
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if fmt == "csv":
        stream = _csv_stream(reader, landing_folder, schema, multi_line)
    else:
        stream = tag_period(normalize_headers(reader.parquet(landing_folder)))
    # The row count below sums all progress reports of this run: keep every one.
    retained = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(retained)
    spark.conf.set(retained, str(2**31 - 1))
    try:
        query = _start(stream, table_path, ckpt)
        query.awaitTermination()
        return sum(int(p.get("numInputRows", 0)) for p in query.recentProgress)
    finally:
        spark.conf.set(retained, before)


def _csv_stream(reader: DataStreamReader, folder: str, schema: StructType, multi_line: bool) -> DataFrame:
    """CSV files whose header is ``schema``'s (any other header is an error,
    as is a row with more or fewer cells than it)."""
    kept = StructType([*schema.fields, StructField(RAGGED, StringType())])
    df = (reader.schema(kept).options(**CSV_READ).option("header", True).option("enforceSchema", False)
          .option("columnNameOfCorruptRecord", RAGGED).option("columnPruning", False)
          .option("multiLine", multi_line).csv(folder))
    names = clean_names([f.name for f in schema.fields])
    df = df.toDF(*names, RAGGED).withColumn(SOURCE_FILE, source_name())
    df = reject_ragged_rows(df, names[0]).drop(RAGGED)
    return df.withColumn("period", period_from_filename(SOURCE_FILE))


def _start(stream: DataFrame, table_path: str, ckpt: str) -> StreamingQuery:
    return (stream.writeStream.format("parquet")
            .option("path", table_path)
            .option("checkpointLocation", ckpt)
            .partitionBy("period")
            .outputMode("append")
            .trigger(availableNow=True)
            .start())
