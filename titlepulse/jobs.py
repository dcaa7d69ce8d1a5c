"""The jobs that write tables, in the order they depend on each other."""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse import schemas
from titlepulse.plans import attention, catalogue, engagement, estimates, leaderboard, reviews, titles
from titlepulse.sources.landing import landing_files, read_landing, type_envelopes
from titlepulse.sources.seed import crosswalk
from titlepulse.sources.shared import delete_folder, stage, staging_root
from titlepulse.sources.tables import Tables

BRONZE_PARTITIONS = ("source", "batch_id")
LANDING_FILES = "path string, batch_id string"

# Every table of a lake, for reading by name.
TABLES = {
    "bronze_game_events": schemas.BRONZE,
    "silver_titles": schemas.TITLES,
    "silver_engagement_daily": schemas.ENGAGEMENT,
    "silver_reviews": schemas.REVIEWS,
    "silver_sales_estimates": schemas.ESTIMATES,
    "gold_platform_trends": schemas.PLATFORM_TRENDS,
    "gold_genre_trends": schemas.GENRE_TRENDS,
    "gold_attention_trends": schemas.ATTENTION_TRENDS,
    "gold_steam_vs_offsteam": schemas.COHORT_SPLIT,
    "gold_title_monthly": schemas.TITLE_MONTHLY,
    "gold_revenue_engagement": schemas.REVENUE_ENGAGEMENT,
}


def register_views(tables: Tables) -> None:
    """Make every table of the lake a view that ``spark.sql`` knows by its name."""
    tables.register_views(TABLES)


def unread_files(tables: Tables, there: DataFrame, batch_id: str) -> DataFrame:
    """Of the files in the column ``path``, those that no other batch has read."""
    others = tables.read("bronze_landing_files", LANDING_FILES).where(F.col("batch_id") != batch_id)
    # Listings and streams write the slashes after the scheme differently.
    named = lambda df: df.withColumn("_name", F.regexp_replace("path", "^(\\w+):/+", "$1:/"))
    return named(there).join(named(others), "_name", "left_anti").select("path")


def append_landed(tables: Tables, rows: DataFrame, files: DataFrame, batch_id: str) -> None:
    """Append a batch's typed rows, then the note of its files: a batch that failed between the two is read again."""
    with staging_root(tables.spark):
        noted = stage(files.select("path", F.lit(batch_id).alias("batch_id")), "files")
        tables.append_batch("bronze_game_events", rows, BRONZE_PARTITIONS, ("extract_date",))
        tables.append_batch("bronze_landing_files", noted, ("batch_id",))


def ingest(tables: Tables, landing_folder: str, batch_id: str | None = None) -> str:
    """Append the landing files that no other batch has read; returns the batch id, which a retry should pass again.

    Which batch read which file is a table of its own, written after the rows: a retry under the same id reads the
    same files again and replaces its rows.  Landing files are not changed once they are there.
    """
    batch_id = batch_id or str(uuid4())
    spark = tables.spark
    there = spark.createDataFrame([(path,) for path in landing_files(spark, landing_folder)], "path string")
    new = unread_files(tables, there, batch_id)
    paths = [row["path"] for row in new.toLocalIterator()]
    if paths:
        append_landed(tables, type_envelopes(read_landing(spark, paths), batch_id), new, batch_id)
    return batch_id


def bronze(tables: Tables) -> DataFrame:
    return tables.read("bronze_game_events", schemas.BRONZE)


def build_titles(tables: Tables, seed: DataFrame, now: Column) -> DataFrame:
    batch = titles.titles_batch(bronze(tables), seed, now)
    return tables.upsert("silver_titles", batch, schemas.TITLES, titles.TITLE_KEYS, titles.TITLE_RULES)


def _seed_note(seed: DataFrame, sources: tuple[str, ...]) -> str:
    """A note that changes with what the seed says about the sources' keys."""
    found = crosswalk(seed, sources).agg(F.count(F.lit(1)), F.sum(F.xxhash64("source", "entity_key", "game_id").cast("decimal(38,0)"))).first()
    return f"seed:{found[0]}:{found[1]}"


def _new_batches(tables: Tables, name: str, seed_note: str) -> tuple[list[str], bool]:
    """Raw batches that are not part of a table yet, and whether it has to start anew, as the seed has changed.

    Which batches there are, the folders of the raw table tell; a batch counts as complete once a job has seen it.
    """
    applied = tables.applied(name)
    anew = seed_note not in applied
    there = tables.partition_values("bronze_game_events", "batch_id")
    return sorted(there if anew else there - {note.removeprefix("batch:") for note in applied if note.startswith("batch:")}), anew


def _notes(batches: list[str], seed_note: str) -> tuple[str, ...]:
    return (seed_note, *[f"batch:{b}" for b in batches])


def _note_days(tables: Tables, days: DataFrame, feed: str) -> None:
    """Write down which days of titles are about to change; done before the change, so that none is lost on the way."""
    rows = days.select("game_id", "date", F.lit(feed).alias("feed"), F.lit(uuid4().hex).alias("fold"))
    tables.append_batch("silver_changed_days", rows, ("feed", "fold"))


def _pending_days(tables: Tables, feed: str, name: str = "silver_engagement_daily") -> tuple[DataFrame, list[str]]:
    """Days noted in a feed that a table does not have yet, and the names of the notes."""
    applied = tables.applied(name)
    folds = sorted(f.removeprefix("fold=") for f in tables._folders(f"silver_changed_days/rows/feed={feed}") if f.startswith("fold="))
    pending = [fold for fold in folds if f"{feed}:{fold}" not in applied]
    noted = tables.read("silver_changed_days", schemas.CHANGED_DAYS)
    return noted.where((F.col("feed") == feed) & F.col("fold").isin(pending)).select("game_id", "date").distinct(), pending


def _forget_days(tables: Tables, feed: str, folds: list[str]) -> None:
    for fold in folds:
        delete_folder(tables.spark, f"{tables.base}/silver_changed_days/rows/feed={feed}/fold={fold}")


def build_engagement(tables: Tables, seed: DataFrame, now: Column) -> DataFrame:
    """Fold new raw batches into the states of their days, and make the facts of these days anew.

    Other batches are not read; other months, and other buckets of titles, are neither read nor written.
    """
    keys, note = engagement.ENGAGEMENT_KEYS, _seed_note(seed, schemas.SNAPSHOT_SOURCES)
    batches, anew = _new_batches(tables, "silver_engagement_state", note)
    if batches or anew:
        fresh = bronze(tables).where(F.col("batch_id").isin(batches))
        states = stage(engagement.engagement_states(fresh, seed), "states")
        _note_days(tables, states, "snapshots")
        if anew:
            tables.replace("silver_engagement_state", states, applied=_notes(batches, note))
        else:
            tables.upsert("silver_engagement_state", states, schemas.ENGAGEMENT_STATE, keys, engagement.STATE_RULES, applied=_notes(batches, note))
    days, folds = _pending_days(tables, "snapshots")
    if folds:
        days = stage(days, "days")
        states = tables.read_near("silver_engagement_state", schemas.ENGAGEMENT_STATE, days).join(days, keys, "left_semi")
        facts = schemas.conform(engagement.daily_of(states).withColumn("ingested_at", now.cast("timestamp")), schemas.ENGAGEMENT)
        done = tuple(f"snapshots:{fold}" for fold in folds)
        _note_days(tables, days, "attention")
        tables.upsert("silver_engagement_daily", facts, schemas.ENGAGEMENT, keys, engagement.SNAPSHOT_RULES, applied=done)
        _forget_days(tables, "snapshots", folds)
    return tables.read("silver_engagement_daily", schemas.ENGAGEMENT)


def build_reviews(tables: Tables, seed: DataFrame) -> DataFrame:
    """Merge the reviews of new raw batches, then count the days of titles that they have changed anew."""
    note = _seed_note(seed, ("steam_reviews",))
    batches, anew = _new_batches(tables, "silver_reviews", note)
    if batches or anew:
        fresh = bronze(tables).where(F.col("batch_id").isin(batches))
        landed = stage(reviews.reviews_landed(fresh, seed), "reviews")
        before = tables.read_near("silver_reviews", reviews.REVIEWS_KEPT, landed)
        _note_days(tables, reviews.changed_days(before, landed), "reviews")
        tables.upsert(
            "silver_reviews", landed, reviews.REVIEWS_KEPT, reviews.REVIEW_KEYS, reviews.REVIEW_RULES, reviews.REVIEW_ORDER, _notes(batches, note)
        )
    days, folds = _pending_days(tables, "reviews")
    if folds:
        days = stage(days, "days")
        changed = reviews.reviews_of_days(tables.read("silver_reviews", schemas.REVIEWS), days)
        done = tuple(f"reviews:{fold}" for fold in folds)
        tables.upsert(
            "silver_engagement_daily", reviews.reviews_daily(changed), schemas.ENGAGEMENT, engagement.ENGAGEMENT_KEYS, reviews.REVIEW_DAY_RULES, applied=done
        )
        _forget_days(tables, "reviews", folds)
    return tables.read("silver_engagement_daily", schemas.ENGAGEMENT)


def build_estimates(tables: Tables, seed: DataFrame) -> DataFrame:
    """Merge the estimates of new raw batches."""
    note = _seed_note(seed, schemas.ESTIMATE_SOURCES)
    batches, anew = _new_batches(tables, "silver_sales_estimates", note)
    if batches or anew:
        fresh = estimates.estimates_landed(bronze(tables).where(F.col("batch_id").isin(batches)), seed)
        tables.upsert(
            "silver_sales_estimates", fresh, estimates.ESTIMATES_KEPT, estimates.ESTIMATE_KEYS, estimates.ESTIMATE_RULES,
            estimates.ESTIMATE_ORDER, _notes(batches, note),
        )
    return tables.read("silver_sales_estimates", schemas.ESTIMATES)


def build_catalogue(tables: Tables) -> None:
    dimension = tables.read("silver_titles", schemas.TITLES)
    tables.replace("gold_platform_trends", catalogue.platform_trends(dimension), ("release_year",))
    tables.replace("gold_genre_trends", catalogue.genre_trends(dimension), ("release_year",))


def build_trends(tables: Tables) -> DataFrame:
    """The attention table: weeks of changed days, and what follows them in their titles.

    A title's new weeks, and its last one, follow from its carried state: no earlier day is read.  Only titles whose
    earlier weeks have changed are worked out from all their days, and written from the first changed week on.  The state, with the notes of what
    it holds, is committed last: a run that breaks before it is repeated from the same state, with the same rows.
    """
    daily = tables.read("silver_engagement_daily", schemas.ENGAGEMENT)
    days, folds = _pending_days(tables, "attention", "gold_attention_state")
    done = ("whole", *[f"attention:{fold}" for fold in folds])
    if "whole" not in tables.applied("gold_attention_state"):
        indexed = stage(attention.attention_index(attention.weekly_engagement(daily)), "indexed")
        tables.replace("gold_attention_trends", attention.as_trends(indexed))
        tables.replace("gold_attention_state", attention.carried_state(indexed), applied=done)
    elif folds:
        weeks = stage(attention.changed_weeks(days), "weeks")
        held = tables.read_near("gold_attention_state", schemas.ATTENTION_STATE, weeks)
        starts = stage(attention.week_starts(weeks, held), "starts")
        late, in_time = starts.where("late").select("game_id"), starts.where("not late").select("game_id", "start")
        own = weeks.join(in_time, "game_id", "left_semi").select("game_id", F.explode(F.sequence("week", F.date_add("week", 6))).alias("date"))
        read = tables.read_near("silver_engagement_daily", schemas.ENGAGEMENT, own).join(own, ["game_id", "date"], "left_semi")
        if not late.isEmpty():
            read = read.unionByName(daily.join(late, "game_id", "left_semi"))
        carried = held.join(in_time, "game_id")
        indexed = stage(attention.attention_index(attention.weekly_engagement(read), carried=carried), "indexed")
        state = stage(attention.carried_state(indexed, carried), "state")
        changed = indexed.join(starts, "game_id").where("week >= start")
        tables.upsert("gold_attention_trends", attention.as_trends(changed), schemas.ATTENTION_TRENDS, attention.ATTENTION_KEYS, attention.ATTENTION_RULES)
        tables.upsert("gold_attention_state", state, schemas.ATTENTION_STATE, ["game_id"], attention.STATE_RULES, applied=done)
    _forget_days(tables, "attention", folds)
    return tables.read("gold_attention_trends", schemas.ATTENTION_TRENDS)


def build_attention(tables: Tables) -> None:
    """The four tables of attention and revenue; each later one starts from what an earlier one wrote."""
    dimension = tables.read("silver_titles", schemas.TITLES)
    daily = tables.read("silver_engagement_daily", schemas.ENGAGEMENT)
    sales = tables.read("silver_sales_estimates", schemas.ESTIMATES)
    trends = build_trends(tables)
    tables.replace("gold_steam_vs_offsteam", attention.cohort_split(dimension, trends))
    monthly = tables.replace("gold_title_monthly", leaderboard.title_monthly(daily, sales))
    tables.replace("gold_revenue_engagement", leaderboard.revenue_engagement(dimension, monthly, sales))


def run_all(tables: Tables, seed: DataFrame, landing_folder: str, batch_id: str | None = None, now: datetime | None = None, keep_versions: int = 2) -> str:
    """Everything, from the landing folder to the derived tables; what was staged and old versions go at the end."""
    stamp = F.lit(now or datetime.now(timezone.utc))
    batch_id = ingest(tables, landing_folder, batch_id)
    with staging_root(tables.spark):
        build_titles(tables, seed, stamp)
        build_engagement(tables, seed, stamp)
        build_reviews(tables, seed)
        build_estimates(tables, seed)
        build_catalogue(tables)
        build_attention(tables)
    for name in (*TABLES, "silver_engagement_state", "gold_attention_state"):
        if name.startswith(("silver", "gold")):
            tables.expire(name, keep_versions)
    return batch_id
