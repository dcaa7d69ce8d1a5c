"""The attention table from carried state, against one made from all days."""

import datetime as dt
import json
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse import jobs, schemas
from titlepulse.plans import attention
from titlepulse.sources.tables import Tables

MONDAY = dt.date(2023, 9, 4)
GAMES = ["fortnite", "dota-2", "chess", "later"]
COLUMNS = schemas.columns(schemas.ATTENTION_TRENDS)


def polls(seed, games, weeks, share=0.7):
    """Envelopes of some days of the weeks; signals are missing here and there."""
    rng = random.Random(seed)
    rows = []
    for game in games:
        for n in weeks:
            for source, field, value in (("twitch_helix", "viewers", rng.choice([0, rng.randint(1, 999)])), ("google_trends", "trends_index", rng.random() * 100), ("reddit", "posts_today", rng.randint(0, 30))):
                if rng.random() < share:
                    day = MONDAY + dt.timedelta(7 * n + rng.randint(0, 6))
                    rows.append({"source": source, "entity_key": game, "extract_date": str(day), "ingested_at": f"2026-05-01T12:00:{rng.randint(0, 59):02d}+00:00", "payload": json.dumps({field: value, "channels": 1, "subscribers": 5})})
    return rows


@pytest.fixture(scope="module")
def seed(spark):
    return spark.createDataFrame([(g, g, None, g, None, g, g, []) for g in GAMES], schemas.SEED)


NIGHTS = [
    ("first", polls(1, GAMES[:3], range(22)), None),
    ("new weeks, the last one again, a title that was not there, one after a gap",
     polls(2, GAMES[:2], [21, 22, 23]) + polls(3, ["later"], [24, 25], 1.0) + polls(4, ["chess"], [40], 1.0), 21),
    ("a late week of one title", polls(5, ["fortnite"], [3], 1.0) + polls(6, ["dota-2"], [24], 1.0), None),
    ("a broken run after the late week", polls(7, GAMES, [41, 42]), 41),
]


def lost():
    raise OSError("lost")


def test_nights_equal_a_rebuild_and_read_only_what_they_need(spark, seed, tmp_path, monkeypatch):
    tables, landing = Tables(spark, str(tmp_path / "lake")), tmp_path / "landing"
    landing.mkdir()
    read, plain, upsert = [], attention.weekly_engagement, Tables.upsert
    monkeypatch.setattr(attention, "weekly_engagement", lambda days: read.append(days.agg(F.min("date")).first()[0]) or plain(days))
    for number, (label, rows, first) in enumerate(NIGHTS):
        (landing / f"{number}.jsonl").write_text("".join(json.dumps(row) + "\n" for row in rows))
        jobs.ingest(tables, str(landing), f"night-{number}")
        jobs.build_engagement(tables, seed, F.lit("2026-06-01"))
        before = rows_of(tables.read("gold_attention_trends", schemas.ATTENTION_TRENDS), *COLUMNS)
        read.clear()
        if label.startswith("a broken run"):
            with monkeypatch.context() as broken, pytest.raises(OSError):
                broken.setattr(Tables, "upsert", lambda self, name, *args, **options: lost() if name == "gold_attention_state" else upsert(self, name, *args, **options))
                jobs.build_trends(tables)
            read.clear()
        found = rows_of(jobs.build_trends(tables), *COLUMNS)
        assert len(read) == 1, label
        if first is not None:
            assert read[0] >= MONDAY + dt.timedelta(7 * first), label
        monkeypatch.setattr(attention, "weekly_engagement", plain)
        rebuilt = rows_of(attention.attention_trends(tables.read("silver_engagement_daily", schemas.ENGAGEMENT)), *COLUMNS)
        monkeypatch.setattr(attention, "weekly_engagement", lambda days: read.append(days.agg(F.min("date")).first()[0]) or plain(days))
        assert found == rebuilt, label
        if label.startswith("a late week"):
            changed = set(found) - set(before)
            assert {row[0] for row in changed} == {"fortnite", "dota-2"}
            assert min(row[1] for row in changed if row[0] == "fortnite") == str(MONDAY + dt.timedelta(21))
            assert {row[1] for row in changed if row[0] == "dota-2"} == {str(MONDAY + dt.timedelta(7 * 24))}
    state = tables.read("gold_attention_state", schemas.ATTENTION_STATE).collect()
    assert len(state) == 4 and all(len(row.seen_twitch_idx) <= schemas.BASELINE_WEEKS + 1 and len(row.indices) == 2 for row in state)
    # Nothing is left to do.
    read.clear()
    assert rows_of(jobs.build_trends(tables), *COLUMNS) == found and not read
    assert not list(tmp_path.glob("lake/silver_changed_days/rows/feed=attention/fold=*"))
