"""One query per operator of the inventory, over the bound inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from testbed.bindings import Inputs
from titlepulse import functions as fn
from titlepulse import schemas
from titlepulse.operators.upsert import upsert
from titlepulse.plans import (
    attention, catalogue, checks, engagement, estimates, landing_shapes, leaderboard, questions, reviews, titles,
)
from titlepulse.sources import landing
from titlepulse.sources.seed import crosswalk, read_seed
from titlepulse.sources.shared import ensure_shared_folder, fresh_path, stage
from titlepulse.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

NOW = "2026-01-01 00:00:00"


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ensure_shared_folder(spark)
        return flat(function(Inputs(spark, folder)))

    QUERIES[function.__name__] = run
    return function


def flat(df: DataFrame) -> DataFrame:
    """Lists as text and instants as epoch seconds, so that both engines' rows compare as plain values."""
    def column(field: T.StructField):
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(field.name, "|").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_seconds(field.name).alias(field.name)
        return F.col(field.name)

    return df.select([column(field) for field in df.schema])


# ---- sources and sinks ---------------------------------------------------------------------------------------


def event_envelopes(inputs: Inputs) -> DataFrame:
    events = inputs.table("events")
    return landing.envelope(
        events,
        "events",
        F.col("user_id"),
        F.to_date("ts"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("event_id")),
        F.struct("event_id", "event_type"),
    )


def landed(inputs: Inputs) -> DataFrame:
    folder = fresh_path(inputs.spark, "landing")
    landing.write_landing(event_envelopes(inputs), folder)
    return landing.read_landing(inputs.spark, folder, "*.json")


@query
def s1_read_landing(inputs):
    return landed(inputs).drop("ingested_at")


@query
def s2_type_envelopes(inputs):
    return landing.type_envelopes(landed(inputs), "batch-1")


@query
def s2_drop_repeated_envelopes(inputs):
    rows = landing.type_envelopes(event_envelopes(inputs), "batch-1")
    again = rows.where("payload like '%click%'").withColumn("batch_id", F.lit("batch-2"))
    return landing.drop_repeats(rows.unionByName(again))


@query
def s3_append_bronze(inputs):
    tables = Tables(inputs.spark, fresh_path(inputs.spark, "tables"))
    rows = inputs.snapshots
    keys = ("source", "batch_id")
    tables.append_batch("bronze", rows, keys, ("extract_date",))
    tables.append_batch("bronze", rows, keys, ("extract_date",))  # a retry: replaces its own rows
    more = rows.where("source = 'reddit'").withColumn("batch_id", F.lit("batch-2"))
    tables.append_batch("bronze", more, keys, ("extract_date",))
    return tables.read("bronze", schemas.BRONZE).select("source", "entity_key", "extract_date", "batch_id")


@query
def s4_load_seed(inputs):
    folder = fresh_path(inputs.spark, "seed")
    inputs.seed_cells.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return read_seed(inputs.spark, folder).drop("seed_order")


@query
def s5_scan_by_source(inputs):
    tables = Tables(inputs.spark, fresh_path(inputs.spark, "tables"))
    tables.append_batch("bronze", inputs.snapshots, ("source", "batch_id"))
    rows = engagement.scan_sources(tables.read("bronze", schemas.BRONZE), ("reddit", "steam_ccu"))
    return rows.select("source", "entity_key", "extract_date")


@query
def s6_rebuild_partitioned(inputs):
    tables = Tables(inputs.spark, fresh_path(inputs.spark, "tables"))
    tables.replace("gold_platform_trends", catalogue.platform_trends(inputs.catalogue), ("release_year",))
    present = tables.read("gold_platform_trends", schemas.PLATFORM_TRENDS)
    tables.replace("gold_platform_trends", present.where("platform <> 'mac'"), ("release_year",))
    return tables.read("gold_platform_trends", schemas.PLATFORM_TRENDS)


@query
def s7_absent_is_empty(inputs):
    tables = Tables(inputs.spark, fresh_path(inputs.spark, "tables"))
    batch = inputs.estimates
    return tables.upsert("estimates", batch, schemas.ESTIMATES, estimates.ESTIMATE_KEYS, estimates.ESTIMATE_RULES)


@query
def s8_envelope(inputs):
    return event_envelopes(inputs).drop("ingested_at")


# ---- keyed upserts -------------------------------------------------------------------------------------------


@query
def m1_upsert_titles(inputs):
    return upsert(inputs.titles_side("old"), inputs.titles_side("new"), titles.TITLE_KEYS, titles.TITLE_RULES)


def _old_days(inputs):
    return inputs.engagement.where("day(date) % 3 <> 0")


def _new_days(inputs):
    twice = {c: F.col(c) * 2 for c in engagement.SNAPSHOT_COLUMNS}
    batch = inputs.engagement.where("day(date) % 3 = 0 or day(date) % 2 = 0").withColumns(twice).withColumn("ingested_at", F.lit(NOW).cast("timestamp"))
    batch = batch.withColumn("twitch_avg_viewers", F.when(F.day("date") % 5 != 0, F.col("twitch_avg_viewers")))
    return batch


def _old_and_new_reviews(inputs):
    old = inputs.reviews.where("cast(review_id as bigint) % 3 <> 0")
    new = inputs.reviews.where("cast(review_id as bigint) % 3 = 0 or cast(review_id as bigint) % 2 = 0").withColumns(
        {"voted_up": ~F.col("voted_up"), "language": F.lit(None).cast("string")}
    )
    return old, new


@query
def m2_upsert_engagement(inputs):
    return upsert(_old_days(inputs), _new_days(inputs), engagement.ENGAGEMENT_KEYS, engagement.SNAPSHOT_RULES)


@query
def m3_upsert_reviews(inputs):
    old, new = _old_and_new_reviews(inputs)
    return upsert(old, new, reviews.REVIEW_KEYS, reviews.REVIEW_RULES)


@query
def m4_upsert_review_days(inputs):
    batch = inputs.engagement.where("day(date) % 3 = 0 or day(date) % 2 = 0").select(
        "game_id", "date", (F.coalesce("reviews_posted", F.lit(0)) * 2).alias("reviews_posted"), F.lit(0.5).alias("reviews_positive_share")
    )
    return upsert(_old_days(inputs), batch, engagement.ENGAGEMENT_KEYS, reviews.REVIEW_DAY_RULES)


@query
def m5_upsert_estimates(inputs):
    old = inputs.estimates.where("day(snapshot_date) % 3 <> 0")
    new = inputs.estimates.where("day(snapshot_date) % 3 = 0 or day(snapshot_date) % 2 = 0").withColumn(
        "est_revenue_lifetime_usd", F.col("est_revenue_lifetime_usd") * 2
    )
    return upsert(old, new, estimates.ESTIMATE_KEYS, estimates.ESTIMATE_RULES)


def _in_parts(inputs, name, ddl, old, batch, keys, rules):
    """The same upsert on a table in parts: the batch's parts are rewritten, the others stay as they are."""
    tables = Tables(inputs.spark, fresh_path(inputs.spark, "tables"))
    tables.replace(name, schemas.conform(old, ddl))
    return tables.upsert(name, batch, ddl, keys, rules)


@query
def m2_merge_in_parts(inputs):
    return _in_parts(inputs, "silver_engagement_daily", schemas.ENGAGEMENT, _old_days(inputs), _new_days(inputs), engagement.ENGAGEMENT_KEYS, engagement.SNAPSHOT_RULES)


@query
def m3_merge_in_parts(inputs):
    old, new = _old_and_new_reviews(inputs)
    return _in_parts(inputs, "silver_reviews", schemas.REVIEWS, old, new, reviews.REVIEW_KEYS, reviews.REVIEW_RULES)


@query
def j11_engagement_by_batches(inputs):
    """The daily facts out of states of three batches, merged one after the other."""
    tables = Tables(inputs.spark, fresh_path(inputs.spark, "tables"))
    tables.append_batch("bronze", inputs.snapshots.withColumn("batch_id", F.concat(F.lit("b"), F.pmod(F.xxhash64("payload"), F.lit(3)))), ("source", "batch_id"))
    for batch in ("b0", "b1", "b2"):
        rows = tables.read("bronze", schemas.BRONZE).where(F.col("batch_id") == batch)
        states = engagement.engagement_states(rows, inputs.seed)
        merged = tables.upsert("silver_engagement_state", states, schemas.ENGAGEMENT_STATE, engagement.ENGAGEMENT_KEYS, engagement.STATE_RULES)
    return engagement.daily_of(merged)


@query
def j13_reviews_by_batches(inputs):
    """Reviews of three batches of pages, of which the last landed row of a review wins in whatever batch it came."""
    tables = Tables(inputs.spark, fresh_path(inputs.spark, "tables"))
    for n in (2, 0, 1):
        rows = inputs.review_pages.where(F.pmod(F.xxhash64("payload", "ingested_at"), F.lit(3)) == n)
        landed = reviews.reviews_landed(rows, inputs.seed)
        tables.upsert("silver_reviews", landed, reviews.REVIEWS_KEPT, reviews.REVIEW_KEYS, reviews.REVIEW_RULES, reviews.REVIEW_ORDER)
    return tables.read("silver_reviews", schemas.REVIEWS)


# ---- column expressions --------------------------------------------------------------------------------------


@query
def p1_slugify(inputs):
    name = F.concat(F.lit(" "), "p_name", F.lit("!! '"), "p_brand", F.lit("' "))
    return inputs.table("part").select("p_partkey", fn.slugify(name).alias("slug"), fn.slugify(F.lit("?!")).alias("blank"))


@query
def p2_release_year(inputs):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    shapes = ["d MMM, yyyy", "MMM d, yyyy", "yyyy-MM-dd", "yyyy", "'Q4' yyyy"]
    text = F.lit("soon")
    for n, shape in enumerate(shapes):
        text = F.when(key % 6 == n, F.date_format(day, shape)).otherwise(text)
    return inputs.table("orders").select("o_orderkey", fn.release_year(text).alias("release_year"))


@query
def p3_price_cents(inputs):
    return titles.store_titles(inputs.store_payloads).select("appid", "is_free", "price_cents")


@query
def p4_genres(inputs):
    return titles.store_titles(inputs.store_payloads).select("appid", "primary_genre", "genre_list")


@query
def p5_platform_flags(inputs):
    return titles.store_titles(inputs.store_payloads).select("appid", "supports_windows", "supports_mac", "supports_linux")


@query
def p6_unwrap_envelope(inputs):
    bare = inputs.store_payloads.withColumn("payload", F.regexp_extract("payload", r"^\{\"[0-9]+\":(.*)\}$", 1))
    return titles.store_titles(inputs.store_payloads.unionByName(bare)).select("appid", "name")


@query
def p7_parse_object(inputs):
    fields = fn.with_json_fields(inputs.snapshots, F.col("payload"), "viewers bigint, views bigint, trends_index double", ["source"])
    return fields.groupBy("source").agg(
        F.count("viewers").alias("viewers"), F.count("views").alias("views"), F.count("trends_index").alias("trends")
    )


@query
def p8_owner_range(inputs):
    rows = inputs.estimate_snapshots.where("source = 'steamspy_snapshot'")
    low, high = fn.owner_range(F.get_json_object("payload", "$.owners"))
    return rows.select("entity_key", "extract_date", low.alias("low"), high.alias("high"))


@query
def p9_week_start(inputs):
    return inputs.table("orders").select("o_orderkey", fn.iso_day(fn.week_start(F.to_date("o_orderdate"))).alias("week"))


@query
def p10_month_start(inputs):
    return inputs.table("orders").select("o_orderkey", fn.iso_day(fn.month_start(F.to_date("o_orderdate"))).alias("month"))


@query
def p11_epoch_day(inputs):
    return inputs.reviews.select("review_id", fn.day_of_epoch(F.col("review_ts")).alias("day"))


@query
def p12_quarter_start(inputs):
    return inputs.table("orders").select("o_orderkey", fn.quarter_start(F.to_date("o_orderdate")).alias("quarter"))


def _values(inputs):
    return engagement.snapshot_values(inputs.snapshots.withColumn("game_id", F.col("entity_key")))


@query
def p13_strict_types(inputs):
    return _values(inputs).groupBy("game_id").agg(
        F.count("viewers").alias("viewers"), F.count("players").alias("players"), F.count("views").alias("views"), F.count("index").alias("index_values")
    )


@query
def p14_range_guards(inputs):
    return _values(inputs).groupBy("game_id").agg(
        F.min("viewers").alias("viewers"), F.min("players").alias("players"), F.min("subscribers").alias("subscribers"), F.min("posts").alias("posts")
    )


@query
def p15_appid_key(inputs):
    return inputs.estimate_snapshots.select(
        "entity_key", F.col("ingested_at"), fn.appid_key(F.concat(F.lit(" 00"), "entity_key")).alias("appid")
    )


@query
def p16_rounding(inputs):
    value = F.col("l_extendedprice") * F.col("l_discount")
    return inputs.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        fn.round_even(value, 2).alias("two"), fn.round_even(value / 7, 4).alias("four"),
        fn.round_half_even_int(F.col("l_quantity") / 2).alias("whole"),
    )


@query
def p17_safe_ratio(inputs):
    return inputs.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.safe_ratio(F.col("l_quantity"), F.col("l_discount")).alias("ratio")
    )


@query
def p18_sql_scalars(inputs):
    return inputs.sql(
        """
        select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'pending') as status,
               case when o_totalprice >= 100000 or o_orderpriority in ('1-URGENT', '2-HIGH') then 'big' else 'small' end as kind,
               size(split(o_orderpriority, '-')) as parts,
               round(o_totalprice / 1000, 1) as thousands,
               date_sub(to_date(o_orderdate), 35) as earlier,
               o_orderdate is not null and cast(to_date(o_orderdate) as string) >= '1996-01-01' as recent
        from {orders}"""
    )


# ---- landing shapes ------------------------------------------------------------------------------------------


@query
def r1_stream_summary(inputs):
    return landing_shapes.summarize_streams(inputs.streams, inputs.streams, ["category", "poll"])


@query
def r2_capped_streams(inputs):
    return landing_shapes.capped_summary(inputs.streams, ["category"], ["stream_id"])


@query
def r3_posts_of_day(inputs):
    communities = inputs.posts.select("community").unionByName(inputs.table("nation").select(F.concat(F.lit("n"), "n_nationkey").alias("community")))
    return landing_shapes.posts_of_day(inputs.posts, communities, F.lit("2024-01-03").cast("date"))


@query
def r4_unpack_pageviews(inputs):
    return landing_shapes.unpack_pageviews(inputs.conversations_as_lists())


@query
def r5_anchor_rescale(inputs):
    return landing_shapes.rescale_to_anchor(inputs.terms, inputs.anchor)


@query
def r6_week_to_days(inputs):
    return landing_shapes.expand_weeks(inputs.terms, F.lit("2024-01-25").cast("date"))


@query
def r7_date_review_pages(inputs):
    return landing_shapes.date_review_pages(inputs.paged_reviews()).drop("payload")


@query
def r8_unpack_keyed(inputs):
    return landing_shapes.unpack_keyed(inputs.keyed_objects())


@query
def r9_unresolved_keys(inputs):
    return landing_shapes.unresolved_keys(inputs.snapshots, inputs.seed)


# ---- raw to typed tables -------------------------------------------------------------------------------------


@query
def j1_store_titles(inputs):
    return titles.store_titles(inputs.store_payloads)


@query
def j2_latest_store_titles(inputs):
    return titles.latest_store_titles(titles.store_titles(inputs.store_payloads))


def _assembled(inputs):
    return titles.assemble_titles(titles.latest_store_titles(titles.store_titles(inputs.store_payloads)), inputs.seed)


@query
def j3_title_dimension(inputs):
    return _assembled(inputs)


@query
def j4_stamp_titles(inputs):
    stamped = titles.titles_batch(inputs.store_payloads, inputs.seed, F.timestamp_seconds(F.lit(1767225600)))
    return stamped.select("game_id", "source", "ingested_at")


@query
def j5_resolve_titles(inputs):
    return engagement.resolve_titles(inputs.snapshots, inputs.seed, schemas.SNAPSHOT_SOURCES).select("source", "game_id", "ingested_at")


def _daily(inputs, *columns):
    daily = engagement.engagement_daily(inputs.snapshots, inputs.seed)
    return daily.select("game_id", "date", *columns).where(F.coalesce(*[F.col(c).cast("double") for c in columns]).isNotNull())


@query
def j6_stream_viewers(inputs):
    return _daily(inputs, "twitch_avg_viewers", "twitch_peak_viewers", "twitch_avg_channels")


@query
def j7_concurrent_players(inputs):
    return _daily(inputs, "steam_ccu_peak")


@query
def j8_pageviews(inputs):
    return _daily(inputs, "wiki_pageviews")


@query
def j9_search_index(inputs):
    return _daily(inputs, "trends_index")


@query
def j10_community(inputs):
    return _daily(inputs, "reddit_subscribers", "reddit_posts")


@query
def j11_engagement_daily(inputs):
    return engagement.engagement_daily(inputs.snapshots, inputs.seed)


@query
def j12_explode_reviews(inputs):
    return reviews.explode_reviews(inputs.review_pages.select("entity_key", "payload"))


@query
def j13_reviews(inputs):
    return reviews.reviews_batch(inputs.review_pages, inputs.seed)


@query
def j14_reviews_daily(inputs):
    return reviews.reviews_daily(inputs.reviews)


@query
def j15_owner_tiers(inputs):
    rows = inputs.estimate_snapshots.where("source = 'steamspy_snapshot'")
    return estimates.parse_estimates(rows).select("entity_key", "extract_date", "est_owners_low", "est_owners_high", "est_source")


@query
def j16_modelled_sales(inputs):
    rows = inputs.estimate_snapshots.where("source = 'gamalytic'")
    return estimates.parse_estimates(rows).select("entity_key", "ingested_at", "est_units_lifetime", "est_revenue_lifetime_usd", "est_source")


@query
def j17_estimates(inputs):
    return estimates.estimates_batch(inputs.estimate_snapshots, inputs.seed)


# ---- derived tables ------------------------------------------------------------------------------------------


@query
def g1_platform_trends(inputs):
    return catalogue.platform_trends(inputs.catalogue)


@query
def g2_genre_trends(inputs):
    return catalogue.genre_trends(inputs.catalogue)


def _most_days(inputs):
    """No more days than line items, which are counted from the files' footers."""
    return inputs.table("lineitem").count()


def _trends(inputs):
    return attention.attention_trends(inputs.engagement, rows=_most_days(inputs))


@query
def g3_weekly_rollup(inputs):
    return attention.weekly_engagement(inputs.engagement, _most_days(inputs))


@query
def g4_signal_indices(inputs):
    return _trends(inputs).select("game_id", "week", "twitch_idx", "wiki_idx", "trends_idx", "reddit_idx")


@query
def g5_attention_index(inputs):
    return _trends(inputs).select("game_id", "week", "attention_index")


@query
def g6_attention_trends(inputs):
    return _trends(inputs)


def _cohorts(inputs):
    """As in the jobs: the split starts from the written attention table."""
    return attention.cohort_split(inputs.dimension, stage(_trends(inputs), "attention"))


@query
def g7_cohort_split(inputs):
    return _cohorts(inputs)


@query
def g8_top_titles(inputs):
    trends = _trends(inputs)
    return attention.top_titles(trends.select("week", "game_id", "attention_index"))


@query
def g9_monthly_viewers(inputs):
    rows = leaderboard.monthly_viewers(inputs.engagement)
    return rows.select("game_id", "month", fn.round_even(F.col("viewers"), 2).alias("twitch_avg_viewers"))


@query
def g10_monthly_rank(inputs):
    return leaderboard.ranked_months(inputs.engagement).select("game_id", "month", "rank")


@query
def g11_rank_movement(inputs):
    return leaderboard.ranked_months(inputs.engagement).select("game_id", "month", "rank_delta")


@query
def g12_monthly_reviews(inputs):
    return leaderboard.monthly_viewers(inputs.engagement).select("game_id", "month", "reviews_posted")


@query
def g13_latest_estimates(inputs):
    return estimates.latest_estimates(inputs.estimates)


def _monthly(inputs):
    return leaderboard.title_monthly(inputs.engagement, inputs.estimates)


@query
def g13_title_monthly(inputs):
    return _monthly(inputs)


def _revenue(inputs):
    return leaderboard.revenue_engagement(inputs.dimension, _monthly(inputs), inputs.estimates)


@query
def g14_revenue_engagement(inputs):
    return _revenue(inputs)


# ---- questions -----------------------------------------------------------------------------------------------


@query
def q1_top_genres(inputs):
    return questions.top_genres(catalogue.genre_trends(inputs.catalogue))


@query
def q2_price_free_and_paid(inputs):
    return questions.price_free_and_paid(inputs.catalogue)


@query
def q2_price_indie_and_other(inputs):
    return questions.price_indie_and_other(inputs.catalogue, "2-HIGH")


@query
def q3_platform_share_change(inputs):
    return questions.platform_share_change(catalogue.platform_trends(inputs.catalogue), 1996, 2000)


@query
def q4_free_genre_mix(inputs):
    return questions.free_genre_mix(inputs.catalogue)


@query
def q5_peak_year(inputs):
    return questions.peak_year(catalogue.platform_trends(inputs.catalogue))


@query
def q6_yearly_change(inputs):
    return questions.yearly_change(catalogue.genre_trends(inputs.catalogue), "1-URGENT")


@query
def q7_quarterly_viewer_share(inputs):
    return questions.quarterly_viewer_share(_cohorts(inputs)).withColumn("quarter", F.to_date("quarter"))


@query
def q8_off_store_above_store(inputs):
    return questions.off_store_above_store(_monthly(inputs), inputs.dimension.withColumn("on_steam", ~F.col("on_steam")))


@query
def q9_attention_of(inputs):
    return questions.attention_of(_trends(inputs), "supplier-000000007", "1999-01-01")


@query
def q10_biggest_spikes(inputs):
    return questions.biggest_spikes(_trends(inputs), "2001-07-01")


@query
def q11_revenue_per_viewer(inputs):
    return questions.revenue_per_viewer(_revenue(inputs), inputs.dimension)


# ---- reports -------------------------------------------------------------------------------------------------


@query
def d1_rows_per_source(inputs):
    return checks.rows_per_source(inputs.snapshots)


@query
def d2_titles_per_cohort(inputs):
    return checks.titles_per_cohort(inputs.dimension)


@query
def d3_signal_coverage(inputs):
    return checks.signal_coverage(inputs.engagement)


@query
def d4_snapshots_per_source(inputs):
    return checks.snapshots_per_source(inputs.estimates)


@query
def d5_seed_report(inputs):
    return checks.seed_report(inputs.seed)


@query
def d6_share_sums(inputs):
    return checks.share_sums(catalogue.genre_trends(inputs.catalogue))


@query
def d7_platforms_in_order(inputs):
    return checks.by_year_and_platform(catalogue.platform_trends(inputs.catalogue))


@query
def d7_genres_in_order(inputs):
    return checks.by_year_and_share(catalogue.genre_trends(inputs.catalogue))


@query
def d7_first_attention_rows(inputs):
    return checks.first_attention_rows(_trends(inputs))


@query
def d7_cohorts_in_order(inputs):
    return checks.by_week_and_cohort(_cohorts(inputs))


@query
def d7_leaders(inputs):
    return checks.leaders(_monthly(inputs))


@query
def d7_best_revenue_ratios(inputs):
    return checks.best_revenue_ratios(_revenue(inputs))


@query
def j5_crosswalk(inputs):
    return crosswalk(inputs.seed, list(schemas.SOURCE_KEYS))
