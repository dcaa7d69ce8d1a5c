"""Analytical questions over the derived tables, with their parameters.

Single values a question compares with are scalar subqueries, never joins.  Rounding is SQL ``round``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlepulse.functions import exact_mean, safe_ratio, whole_mean


def top_genres(genres: DataFrame, k: int = 5) -> DataFrame:
    """Genres with the most releases in the newest year."""
    newest = genres.agg(F.max("release_year")).scalar()
    rows = genres.where(F.col("release_year") == newest).select("primary_genre", "title_count")
    return rows.orderBy(F.desc("title_count"), "primary_genre").limit(k)


def price_free_and_paid(titles: DataFrame) -> DataFrame:
    """Mean price of free and of paid titles by year, in currency units."""

    def mean_usd(who: Column) -> Column:
        return F.round(F.avg(F.when(who, F.col("price_cents"))) / 100, 2)

    return (
        titles.where("release_year is not null")
        .groupBy("release_year")
        .agg(
            mean_usd(F.col("is_free")).alias("avg_price_free_usd"),
            mean_usd(~F.col("is_free")).alias("avg_price_paid_usd"),
            F.count(F.lit(1)).alias("titles"),
        )
        .orderBy("release_year")
    )


def price_indie_and_other(titles: DataFrame, genre: str = "Indie") -> DataFrame:
    """Mean price by year of titles whose first genre is ``genre``, and of all others, in currency units."""
    own = F.coalesce(F.col("primary_genre") == genre, F.lit(False))

    def mean_usd(who: Column) -> Column:
        return F.round(whole_mean(F.when(who, F.col("price_cents"))) / 100, 2)

    means = [mean_usd(own).alias("avg_price_indie_usd"), mean_usd(~own).alias("avg_price_other_usd")]
    return titles.where("release_year is not null").groupBy("release_year").agg(*means, F.count(F.lit(1)).alias("titles")).orderBy("release_year")


def platform_share_change(platforms: DataFrame, first: int = 2018, last: int = 2024) -> DataFrame:
    """Change of each platform's share of releases between two years."""
    in_year = F.sum("title_count").over(Window.partitionBy("release_year"))
    shares = platforms.where(F.col("release_year").isin(first, last)).withColumn(
        "_share", safe_ratio(F.col("title_count"), in_year)
    )

    def share_in(year: int) -> Column:
        return F.max(F.when(F.col("release_year") == year, F.col("_share")))

    change = F.round(share_in(last) - share_in(first), 4).alias("share_delta")
    return shares.groupBy("platform").agg(change).orderBy(F.desc("share_delta"), "platform")


def free_genre_mix(titles: DataFrame) -> DataFrame:
    """Genres of the free titles and their share."""
    counts = titles.where("is_free").groupBy("primary_genre").agg(F.count(F.lit(1)).alias("titles"))
    everything = counts.agg(F.sum("titles")).scalar()
    share = F.round(safe_ratio(F.col("titles"), everything), 4)
    return counts.withColumn("share", share).orderBy(F.desc("titles"), "primary_genre")


def peak_year(platforms: DataFrame, platform: str = "linux") -> DataFrame:
    """The release year with the most titles on a platform."""
    years = platforms.where(F.col("platform") == platform).select("release_year", "title_count")
    return years.orderBy(F.desc("title_count"), "release_year").limit(1)


def yearly_change(genres: DataFrame, genre: str = "Action") -> DataFrame:
    """Releases of one genre by year and the change from the year before."""
    before = F.lag("title_count").over(Window.partitionBy("primary_genre").orderBy("release_year"))
    return (
        genres.where(F.col("primary_genre") == genre)
        .select("release_year", "title_count", (F.col("title_count") - before).alias("yoy_change"))
        .orderBy("release_year")
    )


def quarterly_viewer_share(cohorts: DataFrame) -> DataFrame:
    """Mean weekly viewer share of each cohort by quarter."""
    quarter = F.date_trunc("quarter", F.to_date("week")).alias("quarter")
    mean = F.round(exact_mean(F.col("twitch_viewer_share")), 4).alias("avg_twitch_viewer_share")
    return cohorts.groupBy(quarter, "cohort").agg(mean).orderBy("quarter", "cohort")


def off_store_above_store(monthly: DataFrame, titles: DataFrame) -> DataFrame:
    """Titles not on the main store that rank above its best title, in the newest month."""
    newest = monthly.agg(F.max("month")).scalar()
    ranked = (
        monthly.where(F.col("month") == newest)
        .join(titles.select("game_id", "on_steam"), "game_id")
        .select("game_id", "twitch_avg_viewers", "rank", "on_steam")
    )
    best = ranked.where("on_steam").agg(F.min("rank")).scalar()
    return ranked.where(~F.col("on_steam") & (F.col("rank") < best)).drop("on_steam").orderBy("rank")


def attention_of(attention: DataFrame, game_id: str = "counter-strike-2", since: str = "2024-01-01") -> DataFrame:
    """Weekly indices of one title since a date."""
    weeks = attention.where((F.col("game_id") == game_id) & (F.col("week") >= since))
    return weeks.select("week", "attention_index", "twitch_idx", "wiki_idx", "trends_idx", "reddit_idx").orderBy("week")


def biggest_spikes(attention: DataFrame, as_of: str | None = None, days: int = 35, k: int = 10) -> DataFrame:
    """Largest week-to-week rises in the ``days`` before ``as_of`` (today when not given)."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    recent = attention.where(F.col("week") >= F.date_sub(today, days).cast("string"))
    return (
        recent.select("game_id", "week", "attention_index", "attention_wow_delta")
        .orderBy(F.desc_nulls_last("attention_wow_delta"), "game_id", "week")
        .limit(k)
    )


def revenue_per_viewer(revenue: DataFrame, titles: DataFrame) -> DataFrame:
    """Mean revenue per viewer of free and of paid titles."""
    known = revenue.where("revenue_per_avg_viewer is not null").select("game_id", "revenue_per_avg_viewer")
    return (
        known.join(titles.select("game_id", "is_free"), "game_id")
        .groupBy("is_free")
        .agg(
            F.round(exact_mean(F.col("revenue_per_avg_viewer")), 2).alias("avg_revenue_per_viewer"),
            F.countDistinct("game_id").alias("titles"),
        )
    )
