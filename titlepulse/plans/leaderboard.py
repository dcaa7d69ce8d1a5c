"""Monthly leaderboard and revenue against viewership."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlepulse.functions import exact_mean_of, iso_day, month_start, round_even, with_exact_parts
from titlepulse.operators.ranking import rank_within
from titlepulse.plans.estimates import latest_estimates
from titlepulse.schemas import REVENUE_ENGAGEMENT, TITLE_MONTHLY, conform


def monthly_viewers(engagement: DataFrame) -> DataFrame:
    """Per title and month: mean daily viewers, unrounded, and reviews; months without viewers have no row."""
    known = engagement.where("game_id is not null and date is not null").select("game_id", "date", "twitch_avg_viewers", "reviews_posted")
    return (
        with_exact_parts(known, {"_viewers": F.col("twitch_avg_viewers")})
        .groupBy("game_id", month_start(F.col("date")).alias("month"))
        .agg(
            exact_mean_of(F.col("_viewers")).alias("viewers"),
            F.coalesce(F.sum("reviews_posted"), F.lit(0)).alias("reviews_posted"),
        )
        .where("viewers is not null")
    )


def ranked_months(engagement: DataFrame) -> DataFrame:
    """Monthly viewers with the title's place in its month and how far it moved since its last month."""
    order = [F.col("viewers").desc(), F.col("game_id").asc()]
    ranked = rank_within(monthly_viewers(engagement), ["month"], order)
    last_rank = F.lag("rank").over(Window.partitionBy("game_id").orderBy("month"))
    return ranked.withColumn("rank_delta", last_rank - F.col("rank"))


def title_monthly(engagement: DataFrame, estimates: DataFrame) -> DataFrame:
    """The leaderboard: rounded viewers, rank, movement (positive is up), reviews, newest revenue estimate."""
    newest = latest_estimates(estimates).select(
        "game_id", F.col("est_revenue_lifetime_usd").alias("est_revenue_snapshot")
    )
    rows = ranked_months(engagement).join(newest, "game_id", "left")
    return conform(
        rows.withColumn("twitch_avg_viewers", round_even(F.col("viewers"), 2)).withColumn(
            "month", iso_day(F.col("month"))
        ),
        TITLE_MONTHLY,
    )


def revenue_engagement(titles: DataFrame, monthly: DataFrame, estimates: DataFrame) -> DataFrame:
    """Revenue per viewer of the titles sold on the main store; takes the leaderboard table."""
    sold = titles.where("on_steam").select("game_id")
    newest = latest_estimates(estimates).select("game_id", "est_revenue_lifetime_usd", "est_units_lifetime")
    rows = monthly.join(sold, "game_id", "left_semi").join(newest, "game_id", "left")
    revenue, viewers = F.col("est_revenue_lifetime_usd"), F.col("twitch_avg_viewers")
    ratio = F.when(revenue != 0, F.try_divide(revenue, viewers))
    return conform(
        rows.withColumn("_ratio", ratio).withColumn("revenue_per_avg_viewer", round_even(F.col("_ratio"), 2)),
        REVENUE_ENGAGEMENT,
    )
