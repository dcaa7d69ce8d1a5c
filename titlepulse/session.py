"""Session settings the jobs are written for.  Every plan also runs on a session built elsewhere."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE coalesces the many small shuffle partitions it is given, and splits the oversized ones of a join, so a
# high starting number suits both a small and a very large run.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}

LOCAL_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def build_session(app: str = "titlepulse", master: str | None = None, **extra: str) -> SparkSession:
    """A session for the jobs; pass ``master="local[n]"`` for a single machine, nothing on a cluster."""
    builder = SparkSession.builder.appName(app)
    settings = dict(CLUSTER_SETTINGS)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings |= LOCAL_SETTINGS
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
