"""The curated crosswalk from each source's own key to a title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlepulse.functions import appid_key, blank_to_null, strip
from titlepulse.schemas import SEED, SOURCE_KEYS, columns

_TEXT_COLUMNS = ("game_id", "name", "twitch_category", "wikipedia_article", "subreddit", "trends_term")


def _unreadable(number: Column) -> Column:
    return number.isNotNull() & number.try_cast("bigint").isNull()


def unreadable_ids(raw: DataFrame) -> DataFrame:
    """The rows of a raw crosswalk whose store id is there and is not a whole number."""
    return raw.where(_unreadable(blank_to_null(F.col("steam_appid"))))


def canonical_key(sources: tuple[str, ...] | list[str]) -> Column:
    """The key of an envelope as the crosswalk writes it; NULL for a store id that is not a number."""
    by_id = [source for source in sources if SOURCE_KEYS[source] == "steam_appid"]
    return F.when(F.col("source").isin(by_id), appid_key(F.col("entity_key"))).otherwise(F.col("entity_key"))


def read_seed(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Read the crosswalk CSV; see :func:`clean_seed`.  ``seed_order`` keeps the order of the lines."""
    reader = spark.read.option("header", True).option("escape", '"')
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return clean_seed(reader.csv(path).withColumn("seed_order", F.monotonically_increasing_id()))


def clean_seed(raw: DataFrame) -> DataFrame:
    """Strip every cell, blank cells to NULL, typed store id, storefronts as a list; rows without id or name go.

    A store id that is there and is not a whole number fails the job: read as NULL, it would move its title to
    another cohort.  ``unreadable_ids`` lists such rows.
    """
    cells = {name: blank_to_null(F.col(name)).alias(name) for name in _TEXT_COLUMNS}
    number = blank_to_null(F.col("steam_appid"))
    wrong = F.raise_error(F.concat(F.lit("seed: not a store id: "), number)).cast("bigint")
    cells["steam_appid"] = F.when(_unreadable(number), wrong).otherwise(number.try_cast("bigint")).alias("steam_appid")
    parts = F.transform(F.split(F.coalesce(F.col("storefronts"), F.lit("")), r"\|"), strip)
    cells["storefronts"] = F.filter(parts, lambda part: part != "").alias("storefronts")
    if "seed_order" in raw.columns:
        cells["seed_order"] = F.col("seed_order")
    ordered = [cells[name] for name in [*columns(SEED), "seed_order"] if name in cells]
    return raw.select(ordered).where("game_id is not null and name is not null")


def seed_rank(seed: DataFrame) -> Column:
    """What decides between seed rows of the same key: the later line, or the larger id without line order."""
    return F.struct("seed_order", "game_id") if "seed_order" in seed.columns else F.struct("game_id")


def crosswalk(seed: DataFrame, sources: tuple[str, ...] | list[str]) -> DataFrame:
    """Long form ``(source, entity_key, game_id)`` of the seed, unique on the first two.

    A key listed for several titles goes to the one listed last; blank keys map to nothing.  Nearly every key is listed
    once, so the pairs are dealt out as they are: combining them before would sort each task's share for nothing.
    """
    used = sorted({SOURCE_KEYS[source] for source in sources})
    pairs = [F.struct(F.lit(s).alias("source"), F.col(SOURCE_KEYS[s]).cast("string").alias("entity_key")) for s in sources]
    long = (
        seed.withColumn("_rank", seed_rank(seed))
        .select("game_id", "_rank", *used)
        .select("game_id", "_rank", F.inline(F.array(*pairs)))
        .where(F.coalesce(F.col("entity_key"), F.lit("")) != "")
    )
    return long.repartition("source", "entity_key").groupBy("source", "entity_key").agg(F.max_by("game_id", "_rank").alias("game_id"))


def tracked_keys(seed: DataFrame) -> DataFrame:
    """Distinct ``(source, entity_key)`` the seed asks each source for."""
    return crosswalk(seed, list(SOURCE_KEYS)).select("source", "entity_key")
