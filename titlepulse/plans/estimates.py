"""Sales estimates: owner tiers and modelled revenue, every snapshot kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.functions import owner_range, with_json_fields
from titlepulse.operators.latest import latest_by
from titlepulse.operators.upsert import BATCH
from titlepulse.plans.engagement import resolve_titles
from titlepulse.schemas import ESTIMATE_SOURCES, ESTIMATES, columns

ESTIMATE_KEYS = ["game_id", "snapshot_date", "est_source"]

ESTIMATE_ORDER = ("landed_at",)
ESTIMATES_KEPT = ESTIMATES + ", landed_at timestamp"
ESTIMATE_RULES = {name: BATCH for name in columns(ESTIMATES_KEPT) if name not in ESTIMATE_KEYS}

_ESTIMATE_PAYLOAD = "owners string, revenue variant, copiesSold variant"


def _present(value: Column) -> Column:
    """Whether a VARIANT holds anything but JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def _number(value: Column) -> Column:
    """Number in a VARIANT; NULL for text, booleans and everything else."""
    number = F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(number, F.try_variant_get(value, "$", "double"))


def parse_estimates(rows: DataFrame) -> DataFrame:
    """Estimate columns of raw rows; rows that say nothing usable are dropped.

    Owner tiers need a readable ``"low .. high"`` text.  Modelled sales need a revenue or a number of copies;
    one of the wrong type is NULL, but the row stays.
    """
    kept = [name for name in rows.columns if name != "payload"]
    low, high = owner_range(F.col("owners"))
    tiers = F.col("source") == "steamspy_snapshot"
    modelled = F.col("source") == "gamalytic"
    parsed = (
        with_json_fields(rows, F.col("payload"), _ESTIMATE_PAYLOAD, kept)
        .where(tiers | (modelled & (_present(F.col("revenue")) | _present(F.col("copiesSold")))))
        .select(
            *kept,
            F.when(tiers, low).alias("est_owners_low"),
            F.when(tiers, high).alias("est_owners_high"),
            F.when(modelled, _number(F.col("copiesSold")).try_cast("bigint")).alias("est_units_lifetime"),
            F.when(modelled, _number(F.col("revenue"))).alias("est_revenue_lifetime_usd"),
            F.when(tiers, F.lit("steamspy")).otherwise(F.lit("gamalytic")).alias("est_source"),
        )
    )
    return parsed.where(modelled | F.col("est_owners_low").isNotNull())


def estimates_landed(bronze: DataFrame, seed: DataFrame) -> DataFrame:
    """Estimates of seeded titles, one row per title, day and source: the last landed one, with when it was landed."""
    rows = (
        resolve_titles(bronze, seed, ESTIMATE_SOURCES)
        .where("extract_date is not null")
        .select("source", "game_id", F.col("extract_date").alias("snapshot_date"), "ingested_at", "payload")
    )
    last = latest_by(parse_estimates(rows).drop("source"), ESTIMATE_KEYS, [F.col("ingested_at")])
    return last.withColumnRenamed("ingested_at", "landed_at").select(columns(ESTIMATES_KEPT))


def estimates_batch(bronze: DataFrame, seed: DataFrame) -> DataFrame:
    """Estimates of seeded titles, one row per title, day and source: the last landed one."""
    return estimates_landed(bronze, seed).select(columns(ESTIMATES))


def latest_estimates(estimates: DataFrame) -> DataFrame:
    """The newest snapshot per title, whatever its source and also when its values are NULL.

    Two sources on one day: the name that sorts last.
    """
    return (
        estimates.groupBy("game_id")
        .agg(
            F.max_by(
                F.struct("snapshot_date", "est_source", "est_revenue_lifetime_usd", "est_units_lifetime"),
                F.struct("snapshot_date", "est_source"),
            ).alias("_newest")
        )
        .select("game_id", "_newest.*")
    )
