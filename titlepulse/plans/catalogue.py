"""Catalogue trends: titles per release year by platform and by genre."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlepulse.functions import round_even, safe_ratio, whole_sum
from titlepulse.schemas import GENRE_TRENDS, PLATFORM_FLAGS, PLATFORM_TRENDS, conform


def _mean_price() -> Column:
    return safe_ratio(whole_sum(F.col("price_cents")), F.count("price_cents"))


def platform_trends(titles: DataFrame) -> DataFrame:
    """Per release year and platform: titles, share of free ones, mean price.  A title counts once per platform."""
    supported = F.filter(
        F.array(*[F.when(F.col(flag), F.lit(platform)) for platform, flag in PLATFORM_FLAGS.items()]),
        lambda platform: platform.isNotNull(),
    )
    counted = (
        titles.where("release_year is not null")
        .select("release_year", "is_free", "price_cents", F.explode(supported).alias("platform"))
        .groupBy("release_year", "platform")
        .agg(
            F.count(F.lit(1)).alias("title_count"),
            F.count_if("is_free").alias("_free"),
            _mean_price().alias("_price"),
        )
    )
    shares = counted.withColumns(
        {
            "free_pct": round_even(safe_ratio(F.col("_free"), F.col("title_count")), 4),
            "avg_price_cents": round_even(F.col("_price"), 2),
        }
    )
    return conform(shares, PLATFORM_TRENDS)


def genre_trends(titles: DataFrame) -> DataFrame:
    """Per release year and main genre: titles, share of the year's titles, mean price."""
    counted = (
        titles.where("release_year is not null")
        .groupBy("release_year", F.coalesce("primary_genre", F.lit("Unknown")).alias("primary_genre"))
        .agg(F.count(F.lit(1)).alias("title_count"), _mean_price().alias("_price"))
    )
    # Over one row per year and genre, not over titles.
    year_total = F.sum("title_count").over(Window.partitionBy("release_year"))
    shares = counted.withColumn("_year_total", year_total).withColumns(
        {
            "release_share": round_even(safe_ratio(F.col("title_count"), F.col("_year_total")), 4),
            "avg_price_cents": round_even(F.col("_price"), 2),
        }
    )
    return conform(shares, GENRE_TRENDS)
