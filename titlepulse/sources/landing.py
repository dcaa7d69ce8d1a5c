"""Landing folder: newline-delimited JSON envelopes, one object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlepulse.schemas import BRONZE, LANDING, columns


def landing_files(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> list[str]:
    """Paths of the landing files; none of them is read."""
    return sorted(read_landing(spark, folder, pattern).inputFiles())


def read_landing(spark: SparkSession, folder: str | list[str], pattern: str = "*.jsonl") -> DataFrame:
    """All envelopes of a folder or of files, every field as text; a field a line lacks is NULL."""
    return spark.read.schema(LANDING).option("pathGlobFilter", pattern).json(folder)


def type_envelopes(raw: DataFrame, batch_id: str) -> DataFrame:
    """Give envelopes their types and stamp the batch; an unreadable date or time is NULL."""
    return raw.select(
        "source",
        "entity_key",
        F.col("extract_date").try_cast("date").alias("extract_date"),
        F.try_to_timestamp("ingested_at").alias("ingested_at"),
        F.lit(batch_id).alias("batch_id"),
        "payload",
    )


def drop_repeats(bronze: DataFrame) -> DataFrame:
    """Keep one copy of an envelope that was landed more than once.

    The copies meet on a digest of the payload, so the shuffle sorts short keys, and equal copies are already
    merged before it.
    """
    same = ["source", "entity_key", "extract_date", "ingested_at", "_digest"]
    kept = (
        bronze.withColumn("_digest", F.sha2(F.coalesce(F.col("payload"), F.lit("")), 256))
        .withColumn("_digest", F.when(F.col("payload").isNull(), F.lit("")).otherwise(F.col("_digest")))
        .groupBy(same)
        .agg(F.min("batch_id").alias("batch_id"), F.first("payload").alias("payload"))
    )
    return kept.select(columns(BRONZE))


def envelope(
    df: DataFrame, source: str, entity_key: Column, extract_date: Column, ingested_at: Column, payload: Column
) -> DataFrame:
    """Shape rows as landing envelopes; ``payload`` is a struct or map column, kept as JSON text."""
    return df.select(
        F.lit(source).alias("source"),
        entity_key.cast("string").alias("entity_key"),
        extract_date.cast("string").alias("extract_date"),
        F.date_format(ingested_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingested_at"),
        F.to_json(payload).alias("payload"),
    )


def write_landing(envelopes: DataFrame, folder: str) -> None:
    """Write envelopes as JSON lines, one file per task."""
    envelopes.write.mode("append").json(folder)
