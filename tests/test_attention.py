import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse import schemas
from titlepulse.plans import attention, leaderboard, questions

MONDAY = dt.date(2024, 1, 1)
SIGNALS = ["twitch_avg_viewers", "wiki_pageviews", "trends_index", "reddit_posts"]


@pytest.fixture
def facts(spark):
    def make(*rows):
        ddl = "game_id string, date date, twitch_avg_viewers double, wiki_pageviews bigint, trends_index double, reddit_posts bigint, reviews_posted bigint"
        full = [tuple(list(r) + [None] * (7 - len(r))) for r in rows]
        return schemas.conform(spark.createDataFrame(full, ddl), schemas.ENGAGEMENT)
    return make


@pytest.fixture
def dimension(spark):
    rows = [("fortnite", False, False), ("dota-2", True, True)]
    return spark.createDataFrame(rows, "game_id string, on_steam boolean, is_free boolean")


def week(n):
    return MONDAY + dt.timedelta(7 * n)


def brute_force(rows, baseline_weeks=13):
    """The attention table by plain loops over weekly values."""
    weekly = defaultdict(lambda: defaultdict(list))
    for game, day, *values in rows:
        for name, value in zip(SIGNALS, values):
            if value is not None:
                weekly[game, day - dt.timedelta(day.weekday())][name].append(value)
    out, past, last = {}, defaultdict(list), {}
    for game, start in sorted(weekly):
        indices = {}
        for name in SIGNALS:
            values = weekly[game, start].get(name)
            if not values:
                indices[name] = None
                continue
            value = sum(values) if name in ("wiki_pageviews", "reddit_posts") else math.fsum(values) / len(values)
            known = past[game, name][-baseline_weeks:]
            base = math.fsum(known) / len(known) if known else 0
            indices[name] = round(value / base * 100, 2) if base > 0 else None
            past[game, name].append(value)
        present = [i for i in indices.values() if i is not None]
        index = round(math.fsum(present) / len(present), 2) if present else None
        change = round(index - last[game], 2) if index is not None and game in last else None
        if index is not None:
            last[game] = index
        out[game, str(start)] = (*indices.values(), index, change)
    return out


@pytest.mark.parametrize("weeks", [13, 3])
def test_attention_matches_plain_loops(facts, weeks):
    generator = random.Random(11)
    rows = []
    for game in ("a", "b", "c"):
        for day in range(0, 210):
            if generator.random() < 0.3:
                continue
            values = [generator.randrange(400) / 4, generator.randrange(900), generator.randrange(4000) / 100, generator.randrange(3)]
            rows.append((game, MONDAY + dt.timedelta(day), *[v if generator.random() < 0.4 else None for v in values]))
    got = attention.attention_trends(facts(*rows), weeks)
    assert got.columns == schemas.columns(schemas.ATTENTION_TRENDS)
    mine = {(r[0], r[1]): tuple(r)[2:8] for r in got.collect()}
    assert mine == brute_force(rows, weeks)


def test_attention_values(facts):
    rows = [("g", week(n), v) for n, v in enumerate([100.0, 200.0, 100.0])]
    got = rows_of(attention.attention_trends(facts(*rows)), "week", "twitch_idx", "attention_index", "attention_wow_delta")
    assert got == [("2024-01-01", None, None, None), ("2024-01-08", 200.0, 200.0, None), ("2024-01-15", 66.67, 66.67, -133.33)]
    both_days = facts(("g", week(0), None, 1000), ("g", week(0) + dt.timedelta(6), None, 500))
    assert attention.attention_trends(both_days).first()["wiki_pageviews"] == 1500
    assert attention.attention_trends(facts(("g", week(0)))).count() == 0


def test_gaps_count_observations_and_the_last_indexed_week(facts):
    rows = facts(
        ("g", week(0), 100.0), ("g", week(1), None, 10), ("g", week(2), 200.0, 30), ("g", week(4), 100.0),
    )
    got = rows_of(attention.attention_trends(rows), "week", "twitch_idx", "wiki_idx", "attention_index", "attention_wow_delta")
    assert got == [
        ("2024-01-01", None, None, None, None), ("2024-01-08", None, None, None, None),
        ("2024-01-15", 200.0, 300.0, 250.0, None), ("2024-01-29", 66.67, None, 66.67, -183.33),
    ]


def test_cohorts(facts, dimension):
    rows = facts(("fortnite", week(0), 300.0, 100), ("dota-2", week(0), 100.0, 100), ("nobody", week(0), 900.0, 900))
    trends = attention.attention_trends(rows)
    assert rows_of(attention.cohort_split(dimension, trends), *schemas.columns(schemas.COHORT_SPLIT)) == [
        ("2024-01-01", "off_steam", 1, 0.75, 0.5, 0), ("2024-01-01", "on_steam", 1, 0.25, 0.5, 0),
    ]
    only_unknown = attention.attention_trends(facts(("nobody", week(0), 9.0)))
    assert rows_of(attention.cohort_split(dimension, only_unknown), *schemas.columns(schemas.COHORT_SPLIT)) == [
        ("2024-01-01", "off_steam", 0, None, None, 0), ("2024-01-01", "on_steam", 0, None, None, 0),
    ]
    assert attention.cohort_split(dimension, trends.limit(0)).count() == 0


def test_unknown_titles_keep_their_place_among_the_top(facts, dimension):
    rows = [(g, week(n), float(v)) for g, vs in {"nobody": (1, 9), "fortnite": (1, 5), "dota-2": (1, 5)}.items() for n, v in enumerate(vs)]
    trends = attention.attention_trends(facts(*rows))
    counts = {k: rows_of(attention.cohort_split(dimension, trends, k).where("week = '2024-01-08'"), "cohort", "top20_attention_titles") for k in (1, 2, 3)}
    assert counts[1] == [("off_steam", 0), ("on_steam", 0)]
    assert counts[2] == [("off_steam", 0), ("on_steam", 1)]  # equal indices: "dota-2" is before "fortnite"
    assert counts[3] == [("off_steam", 1), ("on_steam", 1)]
    assert rows_of(attention.top_titles(trends, 1), "week", "game_id") == [("2024-01-08", "nobody")]


def estimates(spark, *rows):
    frame = spark.createDataFrame(list(rows) or [("x", MONDAY, "gamalytic", 1.0, 1)], "game_id string, snapshot_date date, est_source string, est_revenue_lifetime_usd double, est_units_lifetime bigint")
    return schemas.conform(frame if rows else frame.limit(0), schemas.ESTIMATES)


JAN, FEB, MAR = dt.date(2024, 1, 10), dt.date(2024, 2, 10), dt.date(2024, 3, 10)


def test_leaderboard(spark, facts):
    rows = facts(
        ("a", JAN, 100.0, None, None, None, 1), ("a", JAN + dt.timedelta(1), None, None, None, None, 2), ("b", JAN, 200.0),
        ("a", FEB, 300.0), ("b", FEB, 100.0), ("c", FEB, 100.0), ("a", MAR, None, None, None, None, 5), ("b", MAR, 1.0),
    )
    sales = estimates(spark, ("a", JAN, "gamalytic", 100.0, 1), ("a", dt.date(2024, 6, 1), "gamalytic", 500.0, 2))
    monthly = leaderboard.title_monthly(rows, sales)
    assert rows_of(monthly, *schemas.columns(schemas.TITLE_MONTHLY)) == [
        ("a", "2024-01-01", 100.0, 2, None, 3, 500.0), ("a", "2024-02-01", 300.0, 1, 1, 0, 500.0),
        ("b", "2024-01-01", 200.0, 1, None, 0, None), ("b", "2024-02-01", 100.0, 2, -1, 0, None), ("b", "2024-03-01", 1.0, 1, 1, 0, None),
        ("c", "2024-02-01", 100.0, 3, None, 0, None),
    ]


def test_revenue(spark, facts, dimension):
    rows = facts(("dota-2", JAN, 100.0), ("fortnite", JAN, 50.0))
    sales = estimates(spark, ("dota-2", JAN, "gamalytic", 1000.0, 7))
    monthly = leaderboard.title_monthly(rows, sales)
    revenue = leaderboard.revenue_engagement(dimension, monthly, sales)
    assert rows_of(revenue, *schemas.columns(schemas.REVENUE_ENGAGEMENT)) == [("dota-2", "2024-01-01", 1000.0, 7, 0, 100.0, 10.0)]
    assert rows_of(questions.revenue_per_viewer(revenue, dimension), "is_free", "avg_revenue_per_viewer", "titles") == [(True, 10.0, 1)]
    for none in (estimates(spark), estimates(spark, ("dota-2", JAN, "gamalytic", 0.0, 7)), estimates(spark, ("dota-2", JAN, "steamspy", None, None))):
        assert leaderboard.revenue_engagement(dimension, monthly, none).first()["revenue_per_avg_viewer"] is None


def test_off_store_titles_above_the_best_store_title(spark, dimension):
    ddl = "game_id string, month string, twitch_avg_viewers double, rank int"
    rows = [("fortnite", "2024-02-01", 9.0, 1), ("dota-2", "2024-02-01", 8.0, 2), ("fortnite", "2024-01-01", 9.0, 1)]
    ask = lambda rows: rows_of(questions.off_store_above_store(spark.createDataFrame(rows, ddl), dimension), "game_id", "twitch_avg_viewers", "rank")
    assert ask(rows) == [("fortnite", 9.0, 1)]
    assert ask(rows[:1]) == []  # no store title to compare with


def test_spikes_default_to_today(spark):
    today = dt.date.today()
    rows = [("a", str(today), 1.0, 5.0), ("b", str(today - dt.timedelta(60)), 1.0, 9.0), ("c", str(today), 1.0, None)]
    frame = spark.createDataFrame(rows, "game_id string, week string, attention_index double, attention_wow_delta double")
    assert [r["game_id"] for r in questions.biggest_spikes(frame).collect()] == ["a", "c"]


def test_catalogue_questions(spark):
    ddl = "game_id string, release_year int, is_free boolean, price_cents int, primary_genre string"
    frame = spark.createDataFrame([("a", 2020, True, 0, "Action"), ("b", 2020, False, 1999, "Action"), ("c", 2021, True, 0, "RPG"), ("d", None, False, 5, "RPG")], ddl)
    assert rows_of(questions.price_free_and_paid(frame), "release_year", "avg_price_free_usd", "avg_price_paid_usd", "titles") == [(2020, 0.0, 19.99, 2), (2021, 0.0, None, 1)]
    assert rows_of(questions.free_genre_mix(frame), "primary_genre", "titles", "share") == [("Action", 1, 0.5), ("RPG", 1, 0.5)]
    genres = spark.createDataFrame([(2019, "Action", 5), (2020, "Action", 7), (2020, "RPG", 1)], "release_year int, primary_genre string, title_count bigint")
    assert rows_of(questions.yearly_change(genres), "release_year", "title_count", "yoy_change") == [(2019, 5, None), (2020, 7, 2)]
    platforms = spark.createDataFrame([(2018, "linux", 1), (2018, "mac", 3), (2024, "linux", 3), (2024, "mac", 1)], "release_year int, platform string, title_count bigint")
    assert rows_of(questions.platform_share_change(platforms), "platform", "share_delta") == [("linux", 0.5), ("mac", -0.5)]
    assert tuple(questions.peak_year(platforms).first()) == (2024, 3)
