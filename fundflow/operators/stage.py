"""Cutting lineage through the cluster's shared checkpoint folder.

Small derived tables that many plans reuse (the award lists and their key
sets) are written once as Parquet under the folder named by
``spark.checkpoint.dir`` and read back.  Later plans then scan a few files
instead of re-running the derivation, a lost executor only loses a re-read,
and the planner sees the real on-disk size of the table.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Per-entry overhead of a broadcast hash relation, bytes (row header + hash slot).
ENTRY_OVERHEAD = 48


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.  Only in local mode, when
    none is named (tests), is a private folder created and registered; on a
    cluster an unset folder is an error (a machine-local folder is not
    reachable by other executors)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor can reach "
                               "(HDFS / object store) for staged tables")
        d = tempfile.mkdtemp(prefix="fundflow-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder in the shared checkpoint
    folder and return a DataFrame reading it back, columns in their order."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/fundflow-stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").partitionBy(*partition_by).parquet(path)
    back = spark.read.parquet(path)
    # Partition values are read from folder names, last and with a guessed type.
    return back.select([F.col(f.name).cast(f.dataType) for f in df.schema.fields]) if partition_by else back


@dataclass(frozen=True)
class KeySet:
    """A distinct key DataFrame with a measured size bound."""

    df: DataFrame
    rows: int
    max_len: int

    @property
    def bytes(self) -> int:
        """Upper bound of the in-memory hash relation size."""
        return self.rows * (self.max_len + ENTRY_OVERHEAD)

    def broadcastable(self, limit: int | None = None) -> bool:
        """True when the measured bound fits the session's broadcast limit."""
        if limit is None:
            limit = broadcast_limit(self.df.sparkSession)
        return limit > 0 and self.bytes <= limit


def broadcast_limit(spark: SparkSession) -> int:
    """Broadcast size limit in bytes: ``spark.sql.autoBroadcastJoinThreshold``."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    s = str(raw).strip().lower()
    mult = 1
    for suf, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20),
                   ("g", 1 << 30), ("b", 1)):
        if s.endswith(suf):
            s, mult = s[: -len(suf)], m
            break
    try:
        return int(float(s) * mult)
    except ValueError:
        return 10 << 20


def measure_keys(keys: DataFrame, col: str = "award_number") -> KeySet:
    """Measure a key set (row count and widest key) with one small
    aggregate job, so a broadcast decision rests on a checked bound."""
    r = keys.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(col)).alias("w")).first()
    return KeySet(keys, int(r["n"] or 0), int(r["w"] or 0))
