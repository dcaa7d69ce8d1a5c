"""Nightly runs that read only what is new, against one run over everything."""

import datetime as dt
import json
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse import jobs, schemas
from titlepulse.sources.tables import Tables
from titlepulse.streaming.landing_stream import ingest_new_files

TITLES = {"fortnite": ("Fortnite", "FortNiteBR", None), "dota-2": ("Dota 2", "DotA2", "570")}
SILVER = {"silver_engagement_daily": schemas.ENGAGEMENT, "silver_reviews": schemas.REVIEWS, "silver_sales_estimates": schemas.ESTIMATES}


def night(seed, months, size=60):
    """Envelopes of one night: polls, odd values, reviews that come again and change, estimates of either source."""
    rng = random.Random(seed)
    rows = []

    def add(source, key, day, payload):
        at = f"2026-05-{rng.randint(1, 28):02d}T12:00:{rng.randint(0, 59):02d}+00:00"
        rows.append({"source": source, "entity_key": key, "extract_date": day, "ingested_at": at, "payload": json.dumps(payload)})

    for _ in range(size):
        _, (category, sub, appid) = rng.choice(sorted(TITLES.items()))
        day = f"2024-{rng.choice(months):02d}-{rng.randint(1, 4):02d}"
        add("twitch_helix", category, day, {"viewers": rng.choice([rng.randint(0, 999), "7", None]), "channels": rng.choice([1, 2.25, 0.1, 1e300, None])})
        add("google_trends", category, day, {"trends_index": rng.choice([rng.random() * 100, 80, "n/a"])})
        add("reddit", sub, day, {"subscribers": rng.randint(-1, 9), "posts_today": rng.randint(0, 9)})
        add("steam_ccu", "570", day, {"response": {"player_count": rng.randint(0, 99)}})
        ts = 1704067200 + 86400 * (31 * (rng.choice(months) - 1) + rng.randint(0, 3))
        review = {"recommendationid": str(ts // 86400 * 7 + rng.randint(0, 5)), "timestamp_created": ts, "voted_up": rng.random() < 0.5, "language": rng.choice(["en", None])}
        add("steam_reviews", rng.choice(["570", "999"]), day, {"success": 1, "reviews": [review, {"recommendationid": "x" + str(rng.randint(0, 3)), "timestamp_created": ts}]})
        add(rng.choice(["gamalytic", "steamspy_snapshot"]), "570", day, {"revenue": rng.randint(1, 9), "owners": f"{rng.randint(1, 5)} .. 9"})
    return rows


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(row) + "\n" for row in rows))


def build(tables, seed):
    jobs.build_engagement(tables, seed, F.lit("2026-06-01"))
    jobs.build_reviews(tables, seed)
    jobs.build_estimates(tables, seed)


def content(tables):
    return {name: rows_of(tables.read(name, ddl), *[c for c in schemas.columns(ddl) if c != "ingested_at"]) for name, ddl in SILVER.items()}


@pytest.fixture(scope="module")
def seed(spark):
    rows = [(k, k, int(a) if a else None, c, None, s, c, []) for k, (c, s, a) in TITLES.items()]
    return spark.createDataFrame(rows, schemas.SEED)


@pytest.fixture(scope="module")
def nights():
    return [night(1, [1, 2]), night(2, [2, 3], 8), night(3, [1, 3], 8)]


@pytest.fixture(scope="module")
def at_once(spark, seed, nights, tmp_path_factory):
    folder = tmp_path_factory.mktemp("once")
    for n, rows in enumerate(nights):
        land(folder / "landing", f"{n}.jsonl", rows)
    tables = Tables(spark, str(folder / "lake"))
    jobs.ingest(tables, str(folder / "landing"), "all")
    build(tables, seed)
    return content(tables)


def test_nights_add_up_to_one_run_and_read_no_old_batch(spark, seed, nights, at_once, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    for n, rows in enumerate(nights):
        land(tmp_path / "landing", f"{n}.jsonl", rows)
        jobs.ingest(tables, str(tmp_path / "landing"), f"night {n}")
        build(tables, seed)
        for file in tmp_path.glob(f"lake/bronze_game_events/rows/*/*/*.parquet"):
            file.write_bytes(b"no parquet")  # no later run may read it
        for crc in tmp_path.glob("lake/bronze_game_events/rows/*/*/.*.crc"):
            crc.unlink()
    assert content(tables) == at_once
    # The notes for the attention table wait for its own job.
    assert {folder.parent.name for folder in tmp_path.glob("lake/silver_changed_days/rows/*/fold=*")} == {"feed=attention"}


def test_a_night_writes_only_its_months_and_days(spark, seed, nights, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    for n, rows in enumerate(nights[:2]):
        before = {str(f) for f in tmp_path.glob("lake/silver_engagement_daily/data/**/*.parquet")}
        stamped = rows_of(tables.read("silver_engagement_daily", schemas.ENGAGEMENT), "game_id", "date", "ingested_at") if n else []
        land(tmp_path / "landing", f"{n}.jsonl", rows)
        jobs.ingest(tables, str(tmp_path / "landing"))
        jobs.build_engagement(tables, seed, F.lit(f"2026-06-0{n + 1}"))
    new = {str(f) for f in tmp_path.glob("lake/silver_engagement_daily/data/**/*.parquet")} - before
    assert new and all("p_month=2024-02" in f or "p_month=2024-03" in f for f in new)
    days = {dt.date.fromisoformat(r["extract_date"]) for r in nights[1]}
    kept = [r for r in rows_of(tables.read("silver_engagement_daily", schemas.ENGAGEMENT), "game_id", "date", "ingested_at") if r[1] not in days]
    assert kept == [r for r in stamped if r[1] not in days] and kept


def test_a_run_that_breaks_between_two_commits_is_made_up_for(spark, seed, nights, at_once, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path / "lake"))
    real = Tables.upsert
    for n, rows in enumerate(nights):
        land(tmp_path / "landing", f"{n}.jsonl", rows)
        jobs.ingest(tables, str(tmp_path / "landing"))

        def fails(self, name, *args, **named):
            if name == "silver_engagement_daily":
                raise RuntimeError("lost")
            return real(self, name, *args, **named)

        monkeypatch.setattr(Tables, "upsert", fails)
        for job in (lambda: jobs.build_engagement(tables, seed, F.lit("2026-06-01")), lambda: jobs.build_reviews(tables, seed)):
            with pytest.raises(RuntimeError, match="lost"):
                job()
        monkeypatch.setattr(Tables, "upsert", real)
        if n:
            build(tables, seed)
    assert content(tables) == at_once


def test_a_changed_seed_folds_everything_anew(spark, seed, nights, at_once, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    half = seed.where("game_id = 'dota-2'")
    for n, rows in enumerate(nights):
        land(tmp_path / "landing", f"{n}.jsonl", rows)
        jobs.ingest(tables, str(tmp_path / "landing"))
        build(tables, half if n < 2 else seed)
    assert content(tables) == at_once


def test_batch_and_stream_share_a_ledger(spark, nights, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    land(tmp_path / "landing", "0.jsonl", nights[1])
    jobs.ingest(tables, str(tmp_path / "landing"))
    for n in (1, 2):
        land(tmp_path / "landing", f"{n}.jsonl", nights[n])
        ingest_new_files(tables, str(tmp_path / "landing"), str(tmp_path / "progress")).awaitTermination()
        jobs.ingest(tables, str(tmp_path / "landing"))
    assert jobs.bronze(tables).count() == sum(map(len, (nights[1], nights[1], nights[2])))
    assert tables.read("bronze_landing_files", jobs.LANDING_FILES).count() == 3
