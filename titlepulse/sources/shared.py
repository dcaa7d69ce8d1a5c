"""The shared folder every executor can reach, for data that a plan has to write before it goes on."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Innermost last: the root folder of the run in progress, under which its staged tables lie.
_roots: list[str] = []


def named_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.  Without it there is no place that outlives an executor."""
    named = named_folder(spark)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def ensure_shared_folder(spark: SparkSession) -> None:
    """For tests, the bench and the registered queries: a session on one machine that names no folder gets one."""
    if not named_folder(spark) and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="titlepulse-"))


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{_roots[-1] if _roots else shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def staging_root(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """What is staged inside the block lies under one folder, which is deleted at its end.

    Only for code that writes its results inside the block: a frame that reads a staged table can't be used after it.
    """
    root = fresh_path(spark, label)
    _roots.append(root)
    try:
        yield root
    finally:
        _roots.remove(root)
        delete_folder(spark, root)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run inside the block deletes its shuffle files as it ends, not when the driver next collects garbage.

    For a row of staged tables, none of which needs the shuffles of the one before.  A frame must not be run twice in it.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Every later use sees the same rows, also after lost executors, and the plan starts from files with known
    sizes.  Meant for rolled-up data, not for raw input.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
