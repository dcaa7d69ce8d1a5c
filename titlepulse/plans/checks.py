"""Monitoring and data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.functions import exact_sum, slugify

COVERAGE_COLUMNS = {
    "with_twitch": "twitch_avg_viewers",
    "with_ccu": "steam_ccu_peak",
    "with_wiki": "wiki_pageviews",
    "with_trends": "trends_index",
    "with_reddit": "reddit_subscribers",
}


def rows_per_source(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def titles_per_cohort(titles: DataFrame) -> DataFrame:
    return titles.groupBy("on_steam").agg(F.count(F.lit(1)).alias("titles"))


def signal_coverage(engagement: DataFrame, days: int = 14) -> DataFrame:
    """Titles per day and how many of them have each signal, for the last ``days`` dates."""
    counts = [F.count(column).alias(label) for label, column in COVERAGE_COLUMNS.items()]
    daily = engagement.groupBy("date").agg(F.count(F.lit(1)).alias("titles"), *counts)
    return daily.orderBy(F.col("date").desc()).limit(days)


def snapshots_per_source(estimates: DataFrame) -> DataFrame:
    return estimates.groupBy("est_source").agg(F.count(F.lit(1)).alias("snapshots"))


def seed_report(seed: DataFrame, min_rows: int = 30, min_off_store: int = 5) -> DataFrame:
    """One row: how often the seed breaks each of its rules, and whether it is usable.

    Repeats are counted per key first, so no list of distinct ids is built in one place.
    """
    per_id = seed.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(F.size("storefronts"), F.lit(0)) <= 0).alias("no_storefront"),
        F.count_if(F.col("steam_appid").isNull()).alias("off_store"),
    )
    per_appid = seed.where("steam_appid is not null").groupBy("steam_appid").agg(F.count(F.lit(1)).alias("n"))
    ids = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("seed_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_game_ids"),
        F.coalesce(F.sum("no_storefront"), F.lit(0)).alias("without_storefront"),
        F.coalesce(F.sum("off_store"), F.lit(0)).alias("off_store_rows"),
        F.count_if(F.col("game_id") != slugify(F.col("game_id"))).alias("not_slug_shaped"),
    )
    appids = per_appid.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_appids"))
    # One row each, brought into one row.
    names = ["seed_rows", "repeated_game_ids", "without_storefront", "off_store_rows", "not_slug_shaped", "repeated_appids"]
    stacked = ids.unionByName(appids, allowMissingColumns=True)
    report = stacked.agg(*[F.max(name).alias(name) for name in names])
    broken = F.col("repeated_game_ids") + F.col("repeated_appids") + F.col("without_storefront") + F.col("not_slug_shaped")
    usable = (F.col("seed_rows") >= min_rows) & (F.col("off_store_rows") >= min_off_store) & (broken == 0)
    return report.withColumn("usable", usable)


def share_sums(genres: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Sum of the genre shares per year, and whether it is one within the tolerance."""
    sums = genres.groupBy("release_year").agg(exact_sum(F.col("release_share")).alias("share_sum"))
    return sums.withColumn("balanced", F.abs(F.col("share_sum") - 1) <= tolerance)


def by_year_and_platform(platforms: DataFrame) -> DataFrame:
    return platforms.orderBy("release_year", "platform")


def by_year_and_share(genres: DataFrame) -> DataFrame:
    return genres.orderBy("release_year", F.desc("release_share"), "primary_genre")


def first_attention_rows(attention: DataFrame, rows: int = 10) -> DataFrame:
    return attention.orderBy("game_id", "week").limit(rows)


def by_week_and_cohort(cohorts: DataFrame) -> DataFrame:
    return cohorts.orderBy("week", "cohort")


def leaders(monthly: DataFrame, rows: int = 20) -> DataFrame:
    return monthly.orderBy("month", F.asc_nulls_last("rank")).limit(rows)


def best_revenue_ratios(revenue: DataFrame, rows: int = 20) -> DataFrame:
    return revenue.orderBy(F.desc_nulls_last("revenue_per_avg_viewer"), "game_id", "month").limit(rows)
