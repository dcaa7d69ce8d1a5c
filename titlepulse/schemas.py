"""Table contracts: column names and types, keys, and the registry of attention signals."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: table contracts, source names and time bounds -------------------------------------------

HISTORY_START = "2020-01-01"
HISTORY_START_EPOCH = 1577836800

SEED = (
    "game_id string, name string, steam_appid bigint, twitch_category string, wikipedia_article string, "
    "subreddit string, trends_term string, storefronts array<string>"
)

LANDING = "source string, entity_key string, extract_date string, ingested_at string, payload string"

BRONZE = (
    "source string, entity_key string, extract_date date, ingested_at timestamp, batch_id string, payload string"
)

TITLES = (
    "game_id string, name string, steam_appid bigint, on_steam boolean, storefronts array<string>, "
    "release_year int, is_free boolean, price_cents bigint, supports_windows boolean, supports_mac boolean, "
    "supports_linux boolean, primary_genre string, genre_list array<string>, twitch_category string, "
    "wikipedia_article string, subreddit string, trends_term string, source string, ingested_at timestamp"
)

ENGAGEMENT = (
    "game_id string, date date, twitch_avg_viewers double, twitch_peak_viewers bigint, "
    "twitch_avg_channels double, wiki_pageviews bigint, trends_index double, reddit_posts bigint, "
    "reddit_subscribers bigint, steam_ccu_peak bigint, reviews_posted bigint, reviews_positive_share double, "
    "ingested_at timestamp"
)

REVIEWS = (
    "game_id string, review_id string, review_ts bigint, voted_up boolean, playtime_at_review_min bigint, "
    "language string, received_free boolean"
)

ESTIMATES = (
    "game_id string, snapshot_date date, est_owners_low bigint, est_owners_high bigint, "
    "est_units_lifetime bigint, est_revenue_lifetime_usd double, est_source string"
)

PLATFORM_TRENDS = "release_year int, platform string, title_count bigint, free_pct double, avg_price_cents double"

GENRE_TRENDS = (
    "release_year int, primary_genre string, title_count bigint, release_share double, avg_price_cents double"
)

ATTENTION_TRENDS = (
    "game_id string, week string, twitch_idx double, wiki_idx double, trends_idx double, reddit_idx double, "
    "attention_index double, attention_wow_delta double, twitch_avg_viewers double, wiki_pageviews bigint"
)

# Per title: its last week with a row, the last observations of each signal, and the last indices, oldest first.
ATTENTION_STATE = (
    "game_id string, week date, "
    "seen_twitch_idx array<struct<week:date,value:double>>, seen_wiki_idx array<struct<week:date,value:bigint>>, "
    "seen_trends_idx array<struct<week:date,value:double>>, seen_reddit_idx array<struct<week:date,value:bigint>>, "
    "indices array<struct<week:date,value:double>>"
)

COHORT_SPLIT = (
    "week string, cohort string, title_count bigint, twitch_viewer_share double, wiki_pageview_share double, "
    "top20_attention_titles bigint"
)

TITLE_MONTHLY = (
    "game_id string, month string, twitch_avg_viewers double, rank int, rank_delta int, reviews_posted bigint, "
    "est_revenue_snapshot double"
)

REVENUE_ENGAGEMENT = (
    "game_id string, month string, est_revenue_lifetime_usd double, est_units_lifetime bigint, "
    "reviews_posted bigint, twitch_avg_viewers double, revenue_per_avg_viewer double"
)

# Crosswalk column of the seed that holds each source's own key for a title.
SOURCE_KEYS = {
    "twitch_helix": "twitch_category",
    "steam_ccu": "steam_appid",
    "wikipedia_pageviews": "wikipedia_article",
    "google_trends": "trends_term",
    "reddit": "subreddit",
    "steam_reviews": "steam_appid",
    "steamspy_snapshot": "steam_appid",
    "gamalytic": "steam_appid",
}

SNAPSHOT_SOURCES = ("twitch_helix", "steam_ccu", "wikipedia_pageviews", "google_trends", "reddit")
ESTIMATE_SOURCES = ("steamspy_snapshot", "gamalytic")

PLATFORM_FLAGS = {"windows": "supports_windows", "mac": "supports_mac", "linux": "supports_linux"}

BASELINE_WEEKS = 13
TOP_TITLES = 20

# Partial sums, counts and maxima of a title's day, from which its snapshot columns follow.
ENGAGEMENT_STATE = (
    "game_id string, date date, viewers_sum decimal(38,0), viewers_n bigint, viewers_max bigint, "
    "channels_floor bigint, channels_upper bigint, channels_lower bigint, channels_held bigint, channels_n bigint, channels_plain double, "
    "index_floor bigint, index_upper bigint, index_lower bigint, index_held bigint, index_n bigint, index_plain double, "
    "subscribers_sum decimal(38,0), subscribers_n bigint, players_max bigint, views_max bigint, posts_max bigint"
)

# Days of a title whose facts have to be made anew, by what has changed them.
CHANGED_DAYS = "game_id string, date date, feed string, fold string"

# Tables kept in parts: partition columns, as expressions over the table's key.  Review ids grow with time.  A lake of many
# titles gets layouts with more buckets (an argument of ``Tables``): a part is what a merge rewrites at least.
LAYOUTS = {
    "silver_titles": {"p_bucket": "pmod(xxhash64(game_id), 4)"},
    "silver_engagement_daily": {"p_month": "date_format(date, 'yyyy-MM')", "p_bucket": "pmod(xxhash64(game_id), 4)"},
    "silver_engagement_state": {"p_month": "date_format(date, 'yyyy-MM')", "p_bucket": "pmod(xxhash64(game_id), 4)"},
    "gold_attention_trends": {"p_year": "substring(week, 1, 4)", "p_bucket": "pmod(xxhash64(game_id), 4)"},
    "gold_attention_state": {"p_bucket": "pmod(xxhash64(game_id), 4)"},
    "silver_reviews": {"p_range": "coalesce(floor(try_cast(review_id as bigint) / 5000000), -1 - pmod(xxhash64(review_id), 64))"},
    "silver_sales_estimates": {"p_month": "date_format(snapshot_date, 'yyyy-MM')", "p_bucket": "pmod(xxhash64(game_id), 4)"},
}

# ---- end of fixed values -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Signal:
    """One attention signal: its daily column, how days add up to a week, and the name of its index."""

    column: str
    index: str
    weekly: str  # "mean" for a rate, "sum" for a count


SIGNALS = (
    Signal("twitch_avg_viewers", "twitch_idx", "mean"),
    Signal("wiki_pageviews", "wiki_idx", "sum"),
    Signal("trends_index", "trends_idx", "mean"),
    Signal("reddit_posts", "reddit_idx", "sum"),
)


def columns(ddl: str) -> list[str]:
    """Column names of a contract, in order."""
    return [part.split()[0] for part in ddl.split(", ")]


def conform(df, ddl: str):
    """Project to a contract: its columns, order and types; a column the frame lacks becomes NULL."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    wanted = [part.split(maxsplit=1) for part in ddl.split(", ")]
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in wanted])
