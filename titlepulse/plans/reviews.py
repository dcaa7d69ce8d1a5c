"""Review-level table and its daily rollup."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.functions import day_of_epoch, round_even, safe_ratio, truthy, with_json_fields
from titlepulse.operators.latest import latest_by
from titlepulse.operators.upsert import BATCH
from titlepulse.plans.engagement import resolve_titles
from titlepulse.schemas import HISTORY_START_EPOCH, REVIEWS, columns

REVIEW_KEYS = ["review_id"]
# A rollup batch carries just these, so inserted days leave the other columns NULL.
REVIEW_DAY_RULES = {"reviews_posted": BATCH, "reviews_positive_share": BATCH}

# When a review's row was landed and for which day it was extracted: of several rows, the last counts.
REVIEW_ORDER = ("landed_at", "landed_for")
REVIEWS_KEPT = REVIEWS + ", landed_at timestamp, landed_for date"
REVIEW_RULES = {name: BATCH for name in columns(REVIEWS_KEPT) if name != "review_id"}

_PAGE = "success variant, reviews array<string>"
_REVIEW = (
    "recommendationid string, timestamp_created bigint, voted_up variant, language string, "
    "received_for_free variant, author struct<playtime_at_review: bigint>"
)


def explode_reviews(pages: DataFrame) -> DataFrame:
    """One row per usable review of the successful pages; the pages' other columns are kept.

    Each review is read from its own text, so a broken one costs only itself.
    """
    kept = [name for name in pages.columns if name != "payload"]
    texts = (
        with_json_fields(pages, F.col("payload"), _PAGE, kept)
        .where(truthy(F.col("success")))
        .select(*kept, F.explode("reviews").alias("_text"))
    )
    return (
        with_json_fields(texts, F.col("_text"), _REVIEW, kept)
        .where((F.col("recommendationid") != "") & F.col("timestamp_created").isNotNull())
        .select(
            *kept,
            F.col("recommendationid").alias("review_id"),
            F.col("timestamp_created").alias("review_ts"),
            truthy(F.col("voted_up")).alias("voted_up"),
            F.col("author.playtime_at_review").alias("playtime_at_review_min"),
            "language",
            truthy(F.col("received_for_free")).alias("received_free"),
        )
    )


def reviews_landed(bronze: DataFrame, seed: DataFrame, since: int = HISTORY_START_EPOCH) -> DataFrame:
    """Reviews of seeded titles since an instant, one row per review: the last landed one, with when it was landed."""
    pages = resolve_titles(bronze, seed, ("steam_reviews",)).select("game_id", "extract_date", "ingested_at", "payload")
    recent = explode_reviews(pages).where(F.col("review_ts") >= since)
    last = latest_by(recent, ["review_id"], [F.col("ingested_at"), F.col("extract_date")])
    return last.withColumnsRenamed({"ingested_at": "landed_at", "extract_date": "landed_for"}).select(columns(REVIEWS_KEPT))


def reviews_batch(bronze: DataFrame, seed: DataFrame, since: int = HISTORY_START_EPOCH) -> DataFrame:
    """Reviews of seeded titles since an instant, the start of history by default, one row per review: the last landed one."""
    return reviews_landed(bronze, seed, since).select(columns(REVIEWS))


def changed_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """``game_id, date`` of reviews in ``new``, and of where these were in ``old`` before."""
    before = old.join(new.select("review_id"), "review_id", "left_semi")
    both = new.select("game_id", "review_ts").unionAll(before.select("game_id", "review_ts"))
    return both.select("game_id", day_of_epoch(F.col("review_ts")).alias("date")).where("game_id is not null and date is not null").distinct()


def reviews_of_days(reviews: DataFrame, days: DataFrame) -> DataFrame:
    """The reviews of some days of titles.  The span of the days is a filter that reaches the files' statistics."""
    span = days.agg(F.min("date").alias("low"), F.max("date").alias("high")).first()
    if span["low"] is None:
        return reviews.where("false")
    inside = reviews.where(F.col("review_ts").between(_midnight(span["low"]), _midnight(span["high"]) + 86_399))
    return inside.withColumn("date", day_of_epoch(F.col("review_ts"))).join(days.select("game_id", "date"), ["game_id", "date"], "left_semi").drop("date")


def _midnight(day: date) -> int:
    return (day - date(1970, 1, 1)).days * 86_400


def reviews_daily(reviews: DataFrame) -> DataFrame:
    """Reviews per title and UTC day, and the share of positive ones; runs on the deduplicated table."""
    return (
        reviews.where("game_id is not null and review_ts is not null")
        .groupBy("game_id", day_of_epoch(F.col("review_ts")).alias("date"))
        .agg(F.count(F.lit(1)).alias("reviews_posted"), F.count_if("voted_up").alias("_up"))
        .select(
            "game_id",
            "date",
            "reviews_posted",
            round_even(safe_ratio(F.col("_up"), F.col("reviews_posted")), 4).alias("reviews_positive_share"),
        )
    )
