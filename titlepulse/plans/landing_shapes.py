"""Shaping raw source responses into what is landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.functions import day_of_epoch, round_even, safe_ratio, variant_text, with_json_fields
from titlepulse.operators.lookup import lookup_join
from titlepulse.operators.ranking import top_within
from titlepulse.schemas import SOURCE_KEYS
from titlepulse.sources.seed import canonical_key, tracked_keys
from titlepulse.sources.shared import stage

def summarize_streams(streams: DataFrame, polls: DataFrame, keys: list[str]) -> DataFrame:
    """Viewers, channels and the largest stream per poll, over streams with a non-negative viewer count.

    A poll without such a stream gives zeros.
    """
    counted = (
        streams.where("viewer_count >= 0")
        .groupBy(keys)
        .agg(
            F.sum("viewer_count").alias("viewers"),
            F.count(F.lit(1)).alias("channels"),
            F.max("viewer_count").alias("peak_stream_viewers"),
        )
    )
    return polls.select(keys).distinct().join(counted, keys, "left").fillna(0, ["viewers", "channels", "peak_stream_viewers"])


def cap_streams(streams: DataFrame, keys: list[str], tie: list[str], cap: int) -> DataFrame:
    """The ``cap`` most watched streams of every poll."""
    order = [F.col("viewer_count").desc_nulls_last(), *[F.col(c).asc() for c in tie]]
    return top_within(streams, keys, order, cap)


def capped_summary(streams: DataFrame, keys: list[str], tie: list[str], cap: int | None = None) -> DataFrame:
    """Summary of all streams of a poll, or of its ``cap`` most watched ones, and whether more were there.

    With a cap, one row beyond it is kept until the last step: its presence is the ``truncated`` flag.
    """
    if cap is None:
        rows, valid, more = streams, F.col("viewer_count") >= 0, F.lit(False)
    else:
        rows = cap_streams(streams, keys, tie, cap + 1)
        valid, more = (F.col("viewer_count") >= 0) & (F.col("rank") <= cap), F.max("rank") > cap
    viewers = F.when(valid, F.col("viewer_count"))
    return rows.groupBy(keys).agg(
        F.coalesce(F.sum(viewers), F.lit(0)).alias("viewers"),
        F.count(viewers).alias("channels"),
        F.coalesce(F.max(viewers), F.lit(0)).alias("peak_stream_viewers"),
        more.alias("truncated"),
    )


def posts_of_day(
    posts: DataFrame, communities: DataFrame, day: Column, tie: list[str] | None = None, newest: int | None = None
) -> DataFrame:
    """Per community, how many of its posts, or of its ``newest`` ones, were created on ``day`` (UTC); posts without
    a time count for nothing, a community without posts gives zero."""
    recent = posts
    if newest is not None:
        order = [F.col("created_utc").desc_nulls_last(), *[F.col(c).asc() for c in tie or []]]
        recent = top_within(posts, ["community"], order, newest)
    counted = recent.groupBy("community").agg(
        F.count_if(day_of_epoch(F.col("created_utc")) == day).alias("posts_today")
    )
    return communities.select("community").distinct().join(counted, "community", "left").fillna(0, ["posts_today"])


def unpack_pageviews(responses: DataFrame) -> DataFrame:
    """One row per article and day from responses holding an ``items`` list; items need a text timestamp that
    starts with a date, and a whole number of views."""
    texts = with_json_fields(responses, F.col("payload"), "items array<string>", ["article"])
    items = with_json_fields(
        texts.select("article", F.explode("items").alias("_text")), F.col("_text"), "timestamp variant, views bigint", ["article"]
    )
    stamp = variant_text(F.col("timestamp"))
    return items.select(
        "article", F.try_to_date(F.substring(stamp, 1, 8), "yyyyMMdd").alias("date"), "views"
    ).where("date is not null and views is not null")


def rescale_to_anchor(terms: DataFrame, anchor: DataFrame) -> DataFrame:
    """Search interest ``value`` per term and week as a percentage of the anchor's in the same week.

    Weeks whose anchor is zero or absent, or whose value is absent, are dropped.  ``anchor`` has one row per week.
    """
    scale = stage(anchor.where("value != 0").select("week", F.col("value").alias("_anchor")), "anchor")
    ratio = safe_ratio(F.col("value"), F.col("_anchor")) * 100
    return (
        lookup_join(terms.where("value is not null"), scale, ["week"])
        .withColumn("_ratio", ratio)
        .select("term", "week", round_even(F.col("_ratio"), 2).alias("trends_index"))
    )


def expand_weeks(weekly: DataFrame, end: Column) -> DataFrame:
    """Repeat a weekly row for each of its seven days, none after ``end``."""
    last = F.least(F.date_add("week", 6), end)
    rest = [name for name in weekly.columns if name != "week"]
    return weekly.where(F.col("week") <= end).select(*rest, F.explode(F.sequence("week", last)).alias("date"))


def date_review_pages(pages: DataFrame) -> DataFrame:
    """Every page that holds a review, dated by its oldest one.

    ``pages`` is ``appid, page, payload``.  A review without a time counts as of the end of time; how far back
    reviews are used is for the job that reads them to say.
    """
    read = with_json_fields(pages, F.col("payload"), "reviews array<string>", ["appid", "page", "payload"])
    missing = F.lit(2**31).cast("bigint")
    created = F.transform(
        "reviews", lambda text: F.coalesce(F.from_json(text, "timestamp_created bigint")["timestamp_created"], missing)
    )
    return read.where(F.size("reviews") > 0).select("appid", "page", day_of_epoch(F.array_min(created)).alias("extract_date"), "payload")


def unpack_keyed(responses: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per entry of an object keyed by id, in document order; only the first ``limit`` where it is given."""
    rest = [name for name in responses.columns if name != "payload"]
    entries = F.map_entries(F.from_json("payload", "map<string,variant>"))
    if limit is not None:
        entries = F.slice(entries, 1, limit)
    return (
        responses.select(*rest, F.posexplode(entries).alias("position", "_entry"))
        .select(
            *rest,
            "position",
            F.col("_entry.key").alias("key"),
            F.to_json(F.create_map("_entry.key", "_entry.value")).alias("payload"),
        )
    )


def unresolved_keys(bronze: DataFrame, seed: DataFrame) -> DataFrame:
    """Tracked keys no envelope was landed for, and landed keys the crosswalk does not know."""
    tracked = tracked_keys(seed)
    landed = (
        bronze.where(F.col("source").isin(list(SOURCE_KEYS)) & (F.coalesce(F.col("entity_key"), F.lit("")) != ""))
        # a key that no title could have is reported as it was landed
        .select("source", F.coalesce(canonical_key(list(SOURCE_KEYS)), F.col("entity_key")).alias("entity_key"))
        .distinct()
    )
    keys = ["source", "entity_key"]
    missing = tracked.join(landed, keys, "left_anti").withColumn("problem", F.lit("no data"))
    unknown = landed.join(tracked, keys, "left_anti").withColumn("problem", F.lit("not tracked"))
    return missing.unionByName(unknown)
