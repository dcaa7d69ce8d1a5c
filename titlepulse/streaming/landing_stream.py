"""Landing files that have not been read yet, as a stream that ends when it has caught up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from titlepulse.jobs import append_landed, unread_files
from titlepulse.schemas import LANDING
from titlepulse.sources.landing import type_envelopes
from titlepulse.sources.tables import Tables


def stream_id(spark: SparkSession, progress_folder: str) -> str:
    """The id of a progress folder, the name of a file that is made with the folder's first use."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{progress_folder}/stream-id")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(folder):
        names = sorted(status.getPath().getName() for status in files.listStatus(folder))
        if names:
            return names[0]
    made = uuid.uuid4().hex
    files.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, made)).close()
    return made


def ingest_new_files(tables: Tables, landing_folder: str, progress_folder: str, pattern: str = "*.jsonl") -> StreamingQuery:
    """Append every landing file once.

    The progress folder remembers which files were read; a micro-batch that is run again writes under the same
    batch id and so replaces its own rows.  The batch id holds an id kept in the progress folder: numbers start again
    in every new folder, and must not meet those of another stream or of a folder that was lost.  Which files were read is
    also noted where :func:`titlepulse.jobs.ingest` notes it, and files that it, or another stream, has read are left out.
    """
    stream = stream_id(tables.spark, progress_folder)
    raw = (
        tables.spark.readStream.schema(LANDING).option("pathGlobFilter", pattern).json(landing_folder)
        .select("*", F.col("_metadata.file_path").alias("path"))
    )

    def append(rows: DataFrame, number: int) -> None:
        batch_id = f"stream-{stream}-{number:08d}"
        files = unread_files(tables, rows.select("path").distinct(), batch_id)
        append_landed(tables, type_envelopes(rows.join(files, "path", "left_semi").drop("path"), batch_id), files, batch_id)

    return (
        raw.writeStream.foreachBatch(append)
        .option("checkpointLocation", progress_folder)
        .trigger(availableNow=True)
        .start()
    )
