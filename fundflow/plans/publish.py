"""All-or-nothing publishing of a run's outputs.

The source overwrites its output files one after another, so a run that fails
half-way leaves two quarters mixed.  Here every run writes into a folder of its
own, ``<out>/runs/<run id>/<output>``; when all outputs are written, one entry
is appended to ``<out>/published``.  Readers go by the last entry: they see the
previous run until the new one is whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.sources import read_csv_output, write_csv, write_parquet

ENTRY = "number long, run_id string, outputs array<string>, format string"


def _entries(spark: SparkSession, out_root: str) -> DataFrame | None:
    try:
        return spark.read.schema(ENTRY).json(f"{out_root.rstrip('/')}/published")
    except AnalysisException:
        return None


def published(spark: SparkSession, out_root: str) -> tuple[int, str, list[str], str] | None:
    """Number, id, outputs and format of the run that counts; None before the first."""
    entries = _entries(spark, out_root)
    last = entries.orderBy(F.desc("number"), F.desc("run_id")).first() if entries is not None else None
    return (last["number"], last["run_id"], list(last["outputs"]), last["format"]) if last else None


def publish(spark: SparkSession, outputs: Mapping[str, DataFrame], out_root: str, fmt: str = "csv",
            partition_by: Mapping[str, Iterable[str]] | None = None, run_id: str | None = None) -> str:
    """Write all ``outputs`` as one run and make it the one that counts;
    returns its folder.  A run id is used once: a folder that is there already
    is an error, so a repeated run never mixes with a failed one."""
    out_root = out_root.rstrip("/")
    run_id = run_id or uuid.uuid4().hex
    folder = f"{out_root}/runs/{run_id}"
    for name, df in outputs.items():
        if fmt == "parquet":
            write_parquet(df, f"{folder}/{name}", partition_by=tuple((partition_by or {}).get(name, ())), mode="error")
        else:
            write_csv(df, f"{folder}/{name}", mode="error")
    last = published(spark, out_root)
    entry = (1 + (last[0] if last else 0), run_id, list(outputs), fmt)
    # One file: it is there or not.
    spark.createDataFrame([entry], ENTRY).coalesce(1).write.mode("append").json(f"{out_root}/published")
    return folder


def read_published(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """An output of the run that counts."""
    last = published(spark, out_root)
    if last is None:
        raise FileNotFoundError(f"nothing published under {out_root}")
    _, run_id, outputs, fmt = last
    if name not in outputs:
        raise KeyError(f"{name} is not among the published outputs: {', '.join(outputs)}")
    path = f"{out_root.rstrip('/')}/runs/{run_id}/{name}"
    return spark.read.parquet(path) if fmt == "parquet" else read_csv_output(spark, path)
