"""The library's inputs, derived by Spark from the generated tables.

Where a binding is plain SQL that both engines read alike, its text is kept in ``TEXT`` and is used by the
query and by the check.  Raw envelopes are the exception: here they hold JSON text, which the library has to
parse, while the check derives the same facts from the table's own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlepulse import schemas
from titlepulse.operators.spread import by_rows
from titlepulse.sources.seed import clean_seed

_SUPPLIER_ID = "concat('supplier-', lpad(cast({} as string), 9, '0'))"

TEXT = {
    # Titles with catalogue columns: one per order.
    "catalogue": """
        select concat('order-', cast(o_orderkey as string)) as game_id,
               case when o_orderkey % 13 <> 0 then cast(year(o_orderdate) as int) end as release_year,
               case when o_orderkey % 11 <> 0 then o_orderpriority end as primary_genre,
               o_orderstatus = 'F' as is_free,
               case when o_orderkey % 17 <> 0 then cast(floor(o_totalprice) as bigint) end as price_cents,
               true as supports_windows, o_orderkey % 2 = 0 as supports_mac, o_orderkey % 5 = 0 as supports_linux
        from {orders}""",
    # Title dimension: one per supplier.
    "dimension": f"""
        select {_SUPPLIER_ID.format("s_suppkey")} as game_id, s_suppkey % 3 <> 0 as on_steam,
               s_suppkey % 4 = 0 as is_free
        from {{supplier}}""",
    # Daily engagement: one row per supplier and ship date, with gaps in every signal.
    "engagement": f"""
        select {_SUPPLIER_ID.format("l_suppkey")} as game_id, cast(l_shipdate as date) as date,
               floor(sum(l_quantity) filter (where l_linenumber <> 3) * 100
                     / nullif(count(*) filter (where l_linenumber <> 3), 0) + 0.5) / 100 as twitch_avg_viewers,
               cast(max(l_quantity) as bigint) as twitch_peak_viewers,
               floor(sum(l_linenumber) * 100 / count(*) + 0.5) / 100 as twitch_avg_channels,
               cast(sum(l_quantity) filter (where l_linenumber <> 2) as bigint) as wiki_pageviews,
               floor(sum(round(l_discount * 100)) filter (where l_returnflag = 'A') * 100
                     / nullif(count(*) filter (where l_returnflag = 'A'), 0) + 0.5) / 100 as trends_index,
               nullif(count(*) filter (where l_returnflag = 'R'), 0) as reddit_posts,
               nullif(count(*) filter (where l_returnflag = 'A'), 0) as reddit_subscribers,
               cast(floor(max(l_extendedprice)) as bigint) as steam_ccu_peak,
               nullif(count(*) filter (where l_returnflag = 'N'), 0) as reviews_posted,
               cast(null as double) as reviews_positive_share,
               cast(null as timestamp) as ingested_at
        from {{lineitem}} group by l_suppkey, cast(l_shipdate as date)""",
    # Estimates: one row per customer, day and source; one source never has revenue.
    "estimates": f"""
        select {_SUPPLIER_ID.format("o_custkey")} as game_id, cast(o_orderdate as date) as snapshot_date,
               cast(null as bigint) as est_owners_low, cast(null as bigint) as est_owners_high,
               max(case when o_orderpriority < '4' then cast(floor(o_totalprice / 10) as bigint) end) as est_units_lifetime,
               max(case when o_orderpriority < '4' then o_totalprice end) as est_revenue_lifetime_usd,
               case when o_orderpriority < '4' then 'gamalytic' else 'steamspy' end as est_source
        from {{orders}}
        group by o_custkey, cast(o_orderdate as date),
                 case when o_orderpriority < '4' then 'gamalytic' else 'steamspy' end""",
    # Seed crosswalk, as the text cells of its file: one title per part.
    "seed_cells": """
        select concat(' title-', cast(p_partkey as string)) as game_id,
               concat(p_name, ' ', cast(p_partkey as string)) as name,
               case when p_partkey % 12 <> 0 then concat(cast(p_partkey as string), ' ') else '' end as steam_appid,
               concat('cat ', cast(p_partkey as string)) as twitch_category,
               case when p_partkey % 7 <> 0 then concat('art_', cast(p_partkey as string)) else ' ' end as wikipedia_article,
               concat('sub', cast(p_partkey - p_partkey % 2 as string)) as subreddit,
               case when p_partkey % 5 <> 0 then concat('term ', cast(p_partkey as string)) end as trends_term,
               case when p_partkey % 12 = 0 then ' own | ' when p_partkey % 8 = 1 then '' else 'steam|gog' end as storefronts
        from {part}""",
    # Reviews, one per event.
    "reviews": """
        select concat('user-', cast(user_id as string)) as game_id, cast(event_id as string) as review_id,
               1704067200 + event_id * 26 as review_ts, event_type in ('purchase', 'signup') as voted_up,
               cast(floor(value) as bigint) as playtime_at_review_min, event_type as language,
               event_id % 3 = 0 as received_free
        from {events}""",
    # Streams of a category at a poll (a day), posts of a community.
    "streams": """
        select event_type as category, cast(ts as date) as poll, event_id as stream_id,
               case when event_id % 37 = 0 then -5 when event_id % 41 <> 0 then cast(floor(value * 10) as bigint) end as viewer_count
        from {events}""",
    "posts": """
        select concat('sub', cast(user_id as string)) as community, event_id as post_id,
               case when event_id % 43 <> 0 then 1704067200 + event_id * 26 end as created_utc
        from {events}""",
    # Weekly search interest per term, and the anchor's.
    "terms": """
        select event_type as term, date_sub_week as week, count(*) as value
        from (select event_type, cast(date_trunc('week', ts) as date) as date_sub_week from {events}
              where event_type <> 'view') e
        group by event_type, date_sub_week""",
    "anchor": """
        select cast(date_trunc('week', ts) as date) as week, count(*) as value
        from {events} where event_type = 'view' group by cast(date_trunc('week', ts) as date)""",
}

# The large table of a binding and the key that its groups lie within: dealt out before, as nearly every row is a group.
_DEALT = {"engagement": ("lineitem", "l_suppkey")}

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations")


class Inputs:
    """The bound inputs of one scale."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, dealt: tuple[str, str] | None = None) -> DataFrame:
        used = {name: self.table(name) for name in _TABLES if f"{{{name}}}" in text}
        if dealt:
            used[dealt[0]] = by_rows(used[dealt[0]], dealt[1])
        return self.spark.sql(text, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TEXT:
            raise AttributeError(name)
        return self.sql(TEXT[name], _DEALT.get(name))

    # -- typed seed ----------------------------------------------------------------------------------------

    @property
    def seed(self) -> DataFrame:
        return clean_seed(self.seed_cells)

    # -- raw envelopes -------------------------------------------------------------------------------------

    @property
    def snapshots(self) -> DataFrame:
        """Snapshot envelopes of five sources, from events; some with values of a wrong type, some broken."""
        k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
        user, user_text = F.col("user_id"), F.col("user_id").cast("string")
        kind = F.col("event_type")
        key = (
            F.when(kind == "view", F.concat(F.lit("cat "), user_text))
            .when(kind == "click", user_text)
            .when(kind == "purchase", F.concat(F.lit("art_"), user_text))
            .when(kind == "signup", F.concat(F.lit("term "), user_text))
            .otherwise(F.concat(F.lit("sub"), (user - user % 2).cast("string")))
        )
        source = (
            F.when(kind == "view", "twitch_helix").when(kind == "click", "steam_ccu")
            .when(kind == "purchase", "wikipedia_pageviews").when(kind == "signup", "google_trends")
            .otherwise("reddit")
        )
        return self.table("events").select(
            source.alias("source"),
            key.alias("entity_key"),
            F.when(F.col("event_id") % 50 != 0, F.to_date("ts")).alias("extract_date"),
            F.col("ts").cast("timestamp").alias("ingested_at"),
            F.lit("batch-1").alias("batch_id"),
            _snapshot_payload(kind, k, F.col("event_id")).alias("payload"),
        )

    @property
    def review_pages(self) -> DataFrame:
        """Review pages, one per hundred turns of a conversation; reviews of different pages share ids."""
        turn, conv = F.col("turn"), F.col("conv_id")
        broken_time = (turn == 5) & (conv % 3 == 0)
        review = F.to_json(
            F.struct(
                ((conv % 40) * 100 + turn).cast("string").alias("recommendationid"),
                (F.lit(1577000000) + conv * 100000 + turn * 1000).alias("timestamp_created"),
                (F.col("role") == "user").alias("voted_up"),
                F.col("role").alias("language"),
                (turn % 3 == 0).alias("received_for_free"),
                F.struct(F.length("text").alias("playtime_at_review")).alias("author"),
            )
        )
        text = F.when(broken_time, F.regexp_replace(review, '"timestamp_created":([0-9]+)', '"timestamp_created":"$1"'))
        pages = (
            self.table("conversations")
            .withColumn("_review", F.coalesce(text, review))
            .groupBy("conv_id", F.floor(F.col("turn") / 100).alias("page"))
            .agg(F.array_join(F.collect_list("_review"), ",").alias("_reviews"))
        )
        success = F.when(conv % 29 == 0, "0").otherwise("1")
        return pages.select(
            F.lit("steam_reviews").alias("source"),
            conv.cast("string").alias("entity_key"),
            F.lit("2024-01-01").cast("date").alias("extract_date"),
            F.timestamp_seconds(F.lit(1704067200) + conv).alias("ingested_at"),
            F.lit("batch-1").alias("batch_id"),
            F.concat(F.lit('{"success":'), success, F.lit(',"reviews":['), F.col("_reviews"), F.lit('],"cursor":"c"}')).alias("payload"),
        )

    @property
    def estimate_snapshots(self) -> DataFrame:
        """Estimate envelopes, from orders: owner tiers for two priorities, modelled sales for the others."""
        tiers = F.col("o_orderpriority") >= "4"
        low = F.floor("o_totalprice")
        key = F.col("o_orderkey")
        owners = F.concat(F.format_number(low, 0), F.lit(" .. "), F.format_number(low * 2, 0))
        owners = F.when(key % 19 == 0, F.lit("unknown")).otherwise(owners)
        revenue = F.when(key % 23 == 0, F.lit('"n/a"')).otherwise(F.col("o_totalprice").cast("string"))
        sales = (
            F.when(key % 29 == 0, F.lit('{"price":1}'))
            .when(key % 31 == 0, F.concat(F.lit('{"copiesSold":'), (low / 4).cast("string"), F.lit("}")))
            .otherwise(F.concat(F.lit('{"revenue":'), revenue, F.lit(',"copiesSold":'), low.cast("string"), F.lit("}")))
        )
        return self.table("orders").select(
            F.when(tiers, "steamspy_snapshot").otherwise("gamalytic").alias("source"),
            F.when(key % 37 == 0, F.concat(F.lit("x"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string")).alias("entity_key"),
            F.to_date("o_orderdate").alias("extract_date"),
            F.timestamp_seconds(F.lit(1704067200) + key).alias("ingested_at"),
            F.lit("batch-1").alias("batch_id"),
            F.when(tiers, F.to_json(F.struct(owners.alias("owners")))).otherwise(sales).alias("payload"),
        )

    @property
    def store_payloads(self) -> DataFrame:
        """Store envelopes, from parts: some parts arrive twice, some are unusable, dates in several shapes."""
        key = F.col("p_partkey")
        versions = self.table("part").withColumn(
            "version", F.explode(F.sequence(F.lit(1), F.when(key % 3 == 0, F.lit(2)).otherwise(F.lit(1))))
        )
        year = (F.lit(1990) + key % 35).cast("string")
        date = (
            F.when(key % 6 == 0, F.concat(F.lit("9 Jul, "), year)).when(key % 6 == 1, F.concat(F.lit("Mar 10, "), year))
            .when(key % 6 == 2, F.concat(year, F.lit("-05-01"))).when(key % 6 == 3, F.concat(F.lit("Q4 "), year))
            .when(key % 6 == 4, F.lit("soon"))
        )
        data = F.struct(
            key.alias("steam_appid"),
            F.when(key % 53 != 0, F.concat_ws(" ", "p_name", "p_brand")).alias("name"),
            (F.col("p_size") % 5 == 0).alias("is_free"),
            F.when(key % 9 != 0, F.struct((F.floor(F.col("p_retailprice")) + F.col("version")).alias("final"))).alias("price_overview"),
            F.struct(F.lit(True).alias("windows"), (key % 2 == 0).alias("mac"), (key % 5 == 0).alias("linux")).alias("platforms"),
            F.when(key % 8 != 0, F.array(F.struct(F.col("p_type").alias("description")), F.struct(F.col("p_brand").alias("description")))).alias("genres"),
            F.struct(date.alias("date")).alias("release_date"),
        )
        body = F.to_json(F.struct((key % 47 != 0).alias("success"), data.alias("data")))
        return versions.select(
            F.lit("steam_store").alias("source"),
            F.lit(None).cast("string").alias("entity_key"),
            F.lit(None).cast("date").alias("extract_date"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("version")).alias("ingested_at"),
            F.lit("batch-1").alias("batch_id"),
            F.concat(F.lit('{"'), key.cast("string"), F.lit('":'), body, F.lit("}")).alias("payload"),
        )

    # -- batches for the keyed upserts ---------------------------------------------------------------------

    def titles_side(self, side: str) -> DataFrame:
        return schemas.conform(self.sql(titles_side(side)), schemas.TITLES)

    def conversations_as_lists(self) -> DataFrame:
        """One ``items`` response per hundred turns of a conversation."""
        turn, conv = F.col("turn"), F.col("conv_id")
        stamp = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (turn + conv % 20).cast("int")), "yyyyMMdd")
        views = F.when((turn == 3) & (conv % 2 == 0), F.lit('"n/a"')).otherwise(F.length("text").cast("string"))
        stamp = F.when((turn == 2) & (conv % 3 == 0), F.lit("2024")).otherwise(F.concat(stamp, F.lit("00")))
        item = F.concat(F.lit('{"timestamp":"'), stamp, F.lit('","views":'), views, F.lit("}"))
        return (
            self.table("conversations").withColumn("_item", item)
            .groupBy("conv_id", F.floor(turn / 100).alias("page"))
            .agg(F.array_join(F.collect_list("_item"), ",").alias("_items"))
            .select(
                F.concat(F.lit("art_"), conv.cast("string")).alias("article"),
                F.concat(F.lit('{"items":['), F.col("_items"), F.lit("]}")).alias("payload"),
            )
        )

    def paged_reviews(self) -> DataFrame:
        """One review page per conversation turn: the title is the conversation, pages go back in time."""
        turn, conv = F.col("turn"), F.col("conv_id")
        newest = F.lit(1577836800) + (turn * -86400) + (conv % 9) * 86400
        reviews = F.concat(
            F.lit('[{"timestamp_created":'), (newest + 50).cast("string"), F.lit('},{"timestamp_created":'), newest.cast("string"),
            F.lit('},{"id":1}]'),
        )
        reviews = F.when((turn == 4) & (conv % 4 == 0), F.lit("[]")).otherwise(reviews)
        cursor = F.when((turn == 3) & (conv % 5 == 0), F.lit("")).when((turn == 2) & (conv % 7 == 0), turn.cast("string")).otherwise((turn + 1).cast("string"))
        return self.table("conversations").select(
            conv.cast("string").alias("appid"),
            turn.alias("page"),
            turn.cast("string").alias("requested"),
            F.concat(F.lit('{"reviews":'), reviews, F.lit(',"cursor":"'), cursor, F.lit('"}')).alias("payload"),
        )

    def keyed_objects(self) -> DataFrame:
        """One keyed object per hundred turns of a conversation, keys in no alphabetical order."""
        turn = F.col("turn")
        entry = F.concat(F.lit('"k'), (F.lit(9) - turn).cast("string"), F.lit('":{"n":'), F.length("text").cast("string"), F.lit("}"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct(turn.alias("turn"), entry.alias("entry")))), lambda e: e["entry"])
        return (
            self.table("conversations")
            .groupBy("conv_id", F.floor(turn / 100).alias("page"))
            .agg(F.array_join(ordered, ",").alias("_entries"))
            .select("conv_id", F.concat(F.lit("{"), F.col("_entries"), F.lit("}")).alias("payload"))
        )


def _snapshot_payload(kind: Column, k: Column, event: Column) -> Column:
    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value.cast("string"))

    viewers = F.when(k % 17 == 0, F.concat(F.lit('"'), k.cast("string"), F.lit('"'))).otherwise((k * 7).cast("string"))
    channels = F.when(k % 9 != 0, field("channels", k % 9)).otherwise(F.lit('"language":"en"'))
    players = F.when(k % 13 == 0, F.lit("1.5")).otherwise((k - 3).cast("string"))
    views = F.when(k % 19 == 0, F.lit('"n/a"')).otherwise(k.cast("string"))
    inner = (
        F.when(kind == "view", F.concat_ws(",", field("viewers", viewers), channels, F.lit('"truncated":false')))
        .when(kind == "click", F.concat(F.lit('"response":{"player_count":'), players, F.lit(',"result":1}')))
        .when(kind == "purchase", field("views", views))
        .when(kind == "signup", field("trends_index", k / 4))
        .otherwise(F.concat_ws(",", field("subscribers", k * 1000 + event % 3), field("posts_today", k % 6 - 1)))
    )
    return F.when(event % 101 == 0, F.lit("{bad")).otherwise(F.concat(F.lit("{"), inner, F.lit("}")))


_SIDE = """
        select concat('customer-', cast(c_custkey as string)) as game_id,
               concat(c_name, '{mark}') as name,
               case when c_custkey % {a} <> 0 then c_custkey end as steam_appid,
               c_custkey % {a} <> 0 as on_steam,
               case when c_custkey % {b} = 0 then 2000 + c_nationkey end as release_year,
               case when c_custkey % {c} = 0 then c_nationkey % 2 = 0 end as is_free,
               case when c_custkey % {b} = 0 then cast(floor(c_acctbal) as bigint) end as price_cents,
               true as supports_windows,
               case when c_custkey % {c} = 0 then c_custkey % 7 = 0 end as supports_mac,
               case when c_custkey % {d} = 0 then c_custkey % 11 = 0 end as supports_linux,
               case when c_custkey % {b} = 0 then concat(c_mktsegment, '{mark}') end as primary_genre,
               case when c_custkey % {d} <> 0 then {array}(c_mktsegment, '{mark}') else {empty} end as genre_list,
               case when c_custkey % {d} = 1 then concat('cat', '{mark}') end as twitch_category,
               '{mark}' as source
        from {{customer}} where {keep}"""

_SIDES = {
    "old": {"mark": " old", "a": 4, "b": 2, "c": 3, "d": 2, "keep": "c_custkey % 3 <> 1"},
    "new": {"mark": " new", "a": 5, "b": 3, "c": 5, "d": 3, "keep": "c_custkey % 3 = 1 or c_custkey % 2 = 0"},
}


def titles_side(side: str, array: str = "array", empty: str = "cast(array() as array<string>)") -> str:
    """Text of one side of the title upsert; the two engines spell lists differently."""
    return _SIDE.format(**_SIDES[side], array=array, empty=empty)
