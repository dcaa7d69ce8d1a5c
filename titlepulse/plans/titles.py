"""Title dimension: store payloads and the curated seed joined into one row per title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.functions import release_year, slugify, strip, truthy, variant_text, with_json_fields
from titlepulse.operators.latest import latest_by
from titlepulse.operators.lookup import lookup_join
from titlepulse.operators.upsert import BATCH, COALESCE, EITHER, NONEMPTY
from titlepulse.schemas import TITLES, conform
from titlepulse.sources.seed import seed_rank

TITLE_KEYS = ["game_id"]

# Identity and crosswalk belong to the batch; store metadata is only replaced by something known.
TITLE_RULES = {
    "name": BATCH,
    "steam_appid": COALESCE,
    "on_steam": EITHER,
    "storefronts": BATCH,
    "release_year": COALESCE,
    "is_free": COALESCE,
    "price_cents": COALESCE,
    "supports_windows": COALESCE,
    "supports_mac": COALESCE,
    "supports_linux": COALESCE,
    "primary_genre": COALESCE,
    "genre_list": NONEMPTY,
    "twitch_category": BATCH,
    "wikipedia_article": BATCH,
    "subreddit": BATCH,
    "trends_term": BATCH,
    "source": BATCH,
    "ingested_at": BATCH,
}

_STORE_PAYLOAD = (
    "success variant, data struct<steam_appid: bigint, name: variant, is_free: variant, "
    "price_overview: struct<final: double>, "
    "platforms: struct<windows: variant, mac: variant, linux: variant>, "
    "genres: array<variant>, release_date: variant>"
)

_METADATA = [
    "release_year", "is_free", "price_cents", "supports_windows", "supports_mac", "supports_linux",
    "primary_genre", "genre_list",
]


def _release_number(value: Column) -> Column:
    """Year given as a bare whole number in a plausible range."""
    number = F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    return F.when(number.between(1970, 2100), number.cast("int"))


def _release_text(value: Column) -> Column:
    """Text of a release date: the value itself, or the ``date`` of an object."""
    return F.coalesce(variant_text(value), variant_text(F.try_variant_get(value, "$.date", "variant")))


def _genre_name(entry: Column) -> Column:
    named = variant_text(F.try_variant_get(entry, "$.description", "variant"))
    return strip(F.coalesce(variant_text(entry), named))


def store_titles(bronze: DataFrame) -> DataFrame:
    """One typed row per usable store payload.

    A payload is the body itself, or an object whose first key holds the body.  Rows that are not successful,
    or lack a whole-number id or a name, are dropped.  Parsing costs far more than moving, and a few packed megabytes
    hold many payloads: they are dealt out to all tasks first, copies of one by their time.
    """
    body_keys = F.map_contains_key("_entries", "success") & F.map_contains_key("_entries", "data")
    body = F.when(body_keys, F.col("payload")).otherwise(F.get(F.map_values("_entries"), F.lit(0)))
    dealt = bronze.select("payload", "ingested_at").repartition("payload", "ingested_at")
    entries = dealt.select("payload", "ingested_at", F.explode(F.array(F.from_json("payload", "map<string,string>"))).alias("_entries"))
    read = with_json_fields(entries, body, _STORE_PAYLOAD, ["ingested_at"])
    data = F.col("data")
    genres = F.filter(F.transform(data["genres"], _genre_name), lambda name: F.coalesce(name, F.lit("")) != "")
    usable = read.where(data["steam_appid"].isNotNull() & truthy(F.col("success")))
    named = usable.select(
        "ingested_at",
        "data",
        strip(variant_text(data["name"])).alias("name"),
        truthy(data["is_free"]).alias("is_free"),
        genres.alias("_genres"),
        _release_number(data["release_date"]).alias("_number"),
        _release_text(data["release_date"]).alias("_text"),
    )
    final = data["price_overview"]["final"]
    # Without a price a title costs nothing; a price that no number holds is unknown.
    price = F.when(final.isNull(), F.lit(0)).otherwise(final.try_cast("bigint"))
    return (
        named.where(F.col("name") != "")
        .select(
            data["steam_appid"].alias("appid"),
            "name",
            F.coalesce("_number", release_year(F.col("_text"))).alias("release_year"),
            "is_free",
            F.when(F.col("is_free"), F.lit(0)).otherwise(price).cast("bigint").alias("price_cents"),
            truthy(data["platforms"]["windows"]).alias("supports_windows"),
            truthy(data["platforms"]["mac"]).alias("supports_mac"),
            truthy(data["platforms"]["linux"]).alias("supports_linux"),
            F.when(F.size("_genres") > 0, F.col("_genres")).otherwise(F.array(F.lit("Unknown"))).alias("genre_list"),
            "ingested_at",
        )
        .withColumn("primary_genre", F.get("genre_list", F.lit(0)))
        .select("appid", "name", *_METADATA, "ingested_at")
    )


def latest_store_titles(rows: DataFrame) -> DataFrame:
    """The last ingested row per store id."""
    return latest_by(rows.where("appid is not null"), ["appid"], [F.col("ingested_at")])


def assemble_titles(store: DataFrame, seed: DataFrame) -> DataFrame:
    """One row per title: every seed title, with store metadata once known, and every unseeded store title.

    Store rows take their seed title's id, or else the slug of their name.  Where several rows reach one id,
    the seeded one is used, then the last ingested, then the one with the highest store id.
    """
    rank = seed_rank(seed)
    by_appid = (
        seed.where("steam_appid is not null")
        .groupBy(F.col("steam_appid").alias("appid"))
        .agg(F.max_by(F.struct("game_id", "name", "storefronts"), rank).alias("_seed"))
    )
    seeded = F.col("_seed").isNotNull()
    fronts = F.col("_seed.storefronts")
    resolved = lookup_join(store, by_appid, ["appid"], "left").select(
        F.coalesce(F.col("_seed.game_id"), slugify(F.col("name"))).alias("game_id"),
        F.coalesce(F.col("_seed.name"), F.col("name")).alias("name"),
        F.when(seeded & (F.size(fronts) > 0), fronts).otherwise(F.array(F.lit("steam"))).alias("storefronts"),
        F.col("name").alias("store_name"),
        seeded.alias("seeded"),
        "appid",
        "ingested_at",
        *_METADATA,
    )
    stored = latest_by(resolved, ["game_id"], [F.col("seeded"), F.col("ingested_at"), F.col("appid")])
    planned = seed.groupBy("game_id").agg(
        F.max_by(
            F.struct("name", "steam_appid", "storefronts", "twitch_category", "wikipedia_article", "subreddit", "trends_term"),
            rank,
        ).alias("seed")
    )
    both = planned.join(stored.select("game_id", F.struct(*stored.columns).alias("store")), "game_id", "full_outer")
    in_store, in_seed = F.col("store").isNotNull(), F.col("seed").isNotNull()

    def from_store(name: str, otherwise: Column) -> Column:
        return F.when(in_store, F.col(f"store.{name}")).otherwise(otherwise).alias(name)

    def from_seed(name: str, otherwise: Column) -> Column:
        return F.when(in_seed, F.col(f"seed.{name}")).otherwise(otherwise).alias(name)

    unknown = F.lit(None)
    return both.select(
        "game_id",
        from_store("name", F.col("seed.name")),
        F.coalesce(F.col("store.appid"), F.col("seed.steam_appid")).alias("steam_appid"),
        (in_store | F.col("seed.steam_appid").isNotNull()).alias("on_steam"),
        from_store("storefronts", F.col("seed.storefronts")),
        from_store("release_year", unknown),
        from_store("is_free", unknown),
        from_store("price_cents", unknown),
        from_store("supports_windows", F.lit(True)),
        from_store("supports_mac", unknown),
        from_store("supports_linux", unknown),
        from_store("primary_genre", unknown),
        from_store("genre_list", F.array().cast("array<string>")),
        from_seed("twitch_category", F.col("store.store_name")),
        from_seed("wikipedia_article", unknown),
        from_seed("subreddit", unknown),
        from_seed("trends_term", F.col("store.store_name")),
    )


def stamp_titles(titles: DataFrame, now: Column) -> DataFrame:
    """Say where each row's identity comes from, and when it was built."""
    origin = F.when(F.col("steam_appid").isNotNull(), F.lit("steam_store")).otherwise(F.lit("seed_titles"))
    return conform(titles.withColumn("source", origin).withColumn("ingested_at", now.cast("timestamp")), TITLES)


def titles_batch(bronze: DataFrame, seed: DataFrame, now: Column) -> DataFrame:
    """The title rows of a run, ready to merge."""
    payloads = bronze.where(F.col("source") == "steam_store").select("payload", "ingested_at")
    return stamp_titles(assemble_titles(latest_store_titles(store_titles(payloads)), seed), now)
