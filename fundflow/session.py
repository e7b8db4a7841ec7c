"""Session settings for running the flow.

On a cluster pass ``master=None`` (the launcher decides) and name the shared
``spark.checkpoint.dir``; locally ``master="local[N]"`` is enough.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def flow_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings the flow's plans rely on: adaptive execution (coalesce small
    shuffle partitions, split skewed join partitions, switch joins to
    broadcast from measured sizes), UTC session time, no UI server."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def get_spark(master: str | None = None, app: str = "fundflow", shuffle_partitions: int | None = None,
              **extra: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**flow_conf(shuffle_partitions), **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """Another session of the application with the caller's settings and
    ``settings``, for a job that needs its own; the caller's stay as they are."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own
