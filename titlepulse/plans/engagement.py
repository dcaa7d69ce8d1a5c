"""Daily engagement facts from polled and backfilled snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.functions import exact_state, exact_state_mean, round_even, round_half_even_int, safe_ratio, whole_sum, with_exact_parts, with_json_fields
from titlepulse.operators.lookup import lookup_join
from titlepulse.operators.upsert import ADD, BATCH, COALESCE, MOST
from titlepulse.schemas import ENGAGEMENT, ENGAGEMENT_STATE, SNAPSHOT_SOURCES, columns, conform
from titlepulse.sources.seed import canonical_key, crosswalk

ENGAGEMENT_KEYS = ["game_id", "date"]

SNAPSHOT_COLUMNS = (
    "twitch_avg_viewers", "twitch_peak_viewers", "twitch_avg_channels", "wiki_pageviews", "trends_index",
    "reddit_posts", "reddit_subscribers", "steam_ccu_peak",
)

# The review columns are not listed: this job never touches them.
SNAPSHOT_RULES = {name: COALESCE for name in SNAPSHOT_COLUMNS} | {"ingested_at": BATCH}

STATE_RULES = {name: MOST if name.endswith("_max") else ADD for name in columns(ENGAGEMENT_STATE) if name not in ENGAGEMENT_KEYS}

_SNAPSHOT_PAYLOAD = (
    "viewers bigint, channels double, response struct<player_count: bigint>, views bigint, "
    "trends_index double, subscribers bigint, posts_today bigint"
)


def scan_sources(bronze: DataFrame, sources: tuple[str, ...] | list[str]) -> DataFrame:
    """Rows of some sources; on a table partitioned by source only their folders are read."""
    return bronze.where(F.col("source").isin(list(sources))).select(
        "source", "entity_key", "extract_date", "ingested_at", "payload"
    )


def resolve_titles(bronze: DataFrame, seed: DataFrame, sources: tuple[str, ...] | list[str]) -> DataFrame:
    """Rows of the given sources with the ``game_id`` their own key stands for; unknown keys are dropped."""
    rows = scan_sources(bronze, sources).withColumn("entity_key", canonical_key(sources))
    return lookup_join(rows, crosswalk(seed, sources), ["source", "entity_key"])


def _of(source: str, value: Column) -> Column:
    return F.when(F.col("source") == source, value)


def _count_of(source: str, value: Column) -> Column:
    return F.when((F.col("source") == source) & (value >= 0), value)


def snapshot_values(resolved: DataFrame) -> DataFrame:
    """One typed column per signal; each row fills only those of its source, and only with valid values."""
    dated = resolved.where("extract_date is not null").withColumnRenamed("extract_date", "date")
    fields = with_json_fields(dated, F.col("payload"), _SNAPSHOT_PAYLOAD, ["game_id", "date", "source"])
    viewers, index = F.col("viewers"), F.col("trends_index")
    return fields.select(
        "game_id",
        "date",
        _of("twitch_helix", viewers).alias("viewers"),
        _of("twitch_helix", F.when(viewers.isNotNull(), F.coalesce("channels", F.lit(0.0)))).alias("channels"),
        _count_of("steam_ccu", F.col("response.player_count")).alias("players"),
        _count_of("wikipedia_pageviews", F.col("views")).alias("views"),
        _of("google_trends", F.when(~F.isnan(index), index)).alias("index"),
        _count_of("reddit", F.col("subscribers")).alias("subscribers"),
        _count_of("reddit", F.col("posts_today")).alias("posts"),
    )


def engagement_states(bronze: DataFrame, seed: DataFrame) -> DataFrame:
    """Per title and day, what its snapshots add up to: one shuffle for all sources, combined per task before it.

    States of different rows of the raw table are merged by ``STATE_RULES``, in any order, to the state of all.
    """
    values = snapshot_values(resolve_titles(bronze, seed, SNAPSHOT_SOURCES))
    signals = ["viewers", "players", "views", "index", "subscribers", "posts"]
    said = values.where(F.coalesce(*[F.col(s).cast("double") for s in signals]).isNotNull())
    states = (
        with_exact_parts(said, {"_channels": F.col("channels"), "_index": F.col("index")})
        .groupBy("game_id", "date")
        .agg(
            F.coalesce(whole_sum(F.col("viewers")), F.lit(0)).alias("viewers_sum"),
            F.count("viewers").alias("viewers_n"),
            F.max("viewers").alias("viewers_max"),
            *exact_state(F.col("_channels"), "channels"),
            *exact_state(F.col("_index"), "index"),
            F.coalesce(whole_sum(F.col("subscribers")), F.lit(0)).alias("subscribers_sum"),
            F.count("subscribers").alias("subscribers_n"),
            F.max("players").alias("players_max"),
            F.max("views").alias("views_max"),
            F.max("posts").alias("posts_max"),
        )
    )
    return conform(states, ENGAGEMENT_STATE)


def daily_of(states: DataFrame) -> DataFrame:
    """The daily facts that states stand for."""
    means = {"viewers": safe_ratio(F.col("viewers_sum"), F.col("viewers_n")), "subscribers": safe_ratio(F.col("subscribers_sum"), F.col("subscribers_n"))}
    means |= {name: exact_state_mean(name) for name in ("channels", "index")}
    # Out of a generator, as rounding uses its argument several times.
    made = states.select("*", F.inline(F.array(F.struct(*[mean.alias(f"_{name}") for name, mean in means.items()]))))
    return made.select(
        "game_id",
        "date",
        round_even(F.col("_viewers"), 2).alias("twitch_avg_viewers"),
        F.col("viewers_max").alias("twitch_peak_viewers"),
        round_even(F.col("_channels"), 2).alias("twitch_avg_channels"),
        F.col("views_max").alias("wiki_pageviews"),
        round_even(F.col("_index"), 2).alias("trends_index"),
        F.col("posts_max").alias("reddit_posts"),
        round_half_even_int(F.col("_subscribers")).alias("reddit_subscribers"),
        F.col("players_max").alias("steam_ccu_peak"),
    )


def engagement_daily(bronze: DataFrame, seed: DataFrame) -> DataFrame:
    """Wide daily facts per title, from the whole raw table."""
    return daily_of(engagement_states(bronze, seed))


def engagement_batch(bronze: DataFrame, seed: DataFrame, now: Column) -> DataFrame:
    """The engagement rows of a run, ready to merge."""
    return conform(engagement_daily(bronze, seed).withColumn("ingested_at", now.cast("timestamp")), ENGAGEMENT)
