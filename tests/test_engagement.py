import datetime as dt
import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse import schemas
from titlepulse.operators.upsert import upsert
from titlepulse.plans import engagement, estimates, reviews

DAY = "2024-03-01"


@pytest.fixture(scope="module")
def wide_seed(spark):
    rows = [
        ("fortnite", "Fortnite", None, "Fortnite", "Fortnite", "FortNiteBR", "Fortnite", ["epic"]),
        ("dota-2", "Dota 2", 570, "Dota 2", "Dota_2", "DotA2", "Dota 2", ["steam"]),
        ("blank", "Blank", 7, "", None, "shared", None, ["steam"]),
        ("zed", "Zed", 8, None, None, "shared", None, ["steam"]),
    ]
    return spark.createDataFrame(rows, schemas.SEED)


def daily(bronze, seed, *rows):
    return {(r["game_id"], str(r["date"])): r.asDict() for r in engagement.engagement_daily(bronze(*rows), seed).collect()}


def test_signals_roll_up_per_title_and_day(bronze, wide_seed):
    out = daily(
        bronze, wide_seed,
        ("twitch_helix", "Fortnite", DAY, {"viewers": 100000, "channels": 500}),
        ("twitch_helix", "Fortnite", DAY, {"viewers": 200000, "channels": 700}),
        ("steam_ccu", "570", DAY, {"response": {"player_count": 400000}}),
        ("steam_ccu", " 0570 ", DAY, {"response": {"player_count": 600000}}),
        ("wikipedia_pageviews", "Dota_2", DAY, {"views": 50000}),
        ("wikipedia_pageviews", "Dota_2", DAY, {"views": 40000}),
        ("google_trends", "Dota 2", DAY, {"trends_index": 80.0}),
        ("google_trends", "Dota 2", DAY, {"trends_index": 81}),
        ("reddit", "DotA2", DAY, {"subscribers": 2, "posts_today": 42}),
        ("reddit", "DotA2", DAY, {"subscribers": 3, "posts_today": 41}),
        ("twitch_helix", "Dota 2", "2024-03-02", {"viewers": 5}),
        ("reddit", "shared", DAY, {"subscribers": 9}),
    )
    assert set(out) == {("fortnite", DAY), ("dota-2", DAY), ("dota-2", "2024-03-02"), ("zed", DAY)}
    fortnite, dota, later = out[("fortnite", DAY)], out[("dota-2", DAY)], out[("dota-2", "2024-03-02")]
    assert (fortnite["twitch_avg_viewers"], fortnite["twitch_peak_viewers"], fortnite["twitch_avg_channels"]) == (150000.0, 200000, 600.0)
    assert fortnite["wiki_pageviews"] is None and fortnite["steam_ccu_peak"] is None
    assert (dota["steam_ccu_peak"], dota["wiki_pageviews"], dota["trends_index"]) == (600000, 50000, 80.5)
    assert (dota["reddit_subscribers"], dota["reddit_posts"]) == (2, 42)  # 2.5 goes to the even side
    assert (later["twitch_avg_viewers"], later["twitch_avg_channels"]) == (5.0, 0.0)


@pytest.mark.parametrize("source, key, payload", [
    ("twitch_helix", "Nobody", {"viewers": 5}), ("twitch_helix", "", {"viewers": 5}), ("twitch_helix", None, {"viewers": 5}),
    ("twitch_helix", "Dota 2", {"viewers": "7"}), ("twitch_helix", "Dota 2", {"viewers": 7.5}), ("twitch_helix", "Dota 2", {"viewers": None}),
    ("twitch_helix", "Dota 2", {"viewers": True}), ("twitch_helix", "Dota 2", "{bad"), ("twitch_helix", "Dota 2", "[1]"),
    ("twitch_helix", "Dota 2", None), ("steam_ccu", "x570", {"response": {"player_count": 5}}),
    ("steam_ccu", "570", {"response": {"player_count": -1}}), ("steam_ccu", "570", {"response": 5}),
    ("wikipedia_pageviews", "Dota_2", {"views": -1}), ("google_trends", "Dota 2", {"trends_index": "80"}),
    ("google_trends", "Dota 2", '{"trends_index": NaN}'), ("reddit", "DotA2", {"subscribers": "n/a"}),
    ("other", "Dota 2", {"viewers": 5}),
])
def test_unusable_snapshots_leave_nothing(bronze, wide_seed, source, key, payload):
    assert engagement.engagement_daily(bronze((source, key, DAY, payload)), wide_seed).count() == 0


def test_no_date_no_row_and_negative_viewers_stay(bronze, wide_seed):
    out = daily(bronze, wide_seed, ("twitch_helix", "Dota 2", None, {"viewers": 5}), ("twitch_helix", "Dota 2", DAY, {"viewers": -5}))
    assert [r["twitch_avg_viewers"] for r in out.values()] == [-5.0]


def page(*items, success=1):
    return {"success": success, "reviews": list(items), "cursor": "c"}


def review(number, ts, up=True, **more):
    return {"recommendationid": str(number), "timestamp_created": ts, "voted_up": up, **more}


NEW, OLD = 1704067200, 1546300800  # 2024-01-01, 2019-01-01


def test_review_pages(bronze, wide_seed):
    full = review(123, 1700000000, language="english", received_for_free=True, author={"playtime_at_review": 340})
    rows = bronze(
        ("steam_reviews", "570", DAY, page(full, {"recommendationid": "9"}, {"timestamp_created": 5}, 7, None, review("", NEW))),
        ("steam_reviews", "570", DAY, page(review(4, NEW), success=0)),
        ("steam_reviews", "570", DAY, "{bad"),
        ("steam_reviews", "570", DAY, {"success": 1, "reviews": {"a": 1}}),
        ("steam_reviews", "570", DAY, page({"recommendationid": 5, "timestamp_created": NEW, "author": 3}, review(6, str(NEW)))),
    )
    got = rows_of(reviews.explode_reviews(rows.select("payload")), *[c for c in schemas.columns(schemas.REVIEWS) if c != "game_id"])
    assert got == [("123", 1700000000, True, 340, "english", True), ("5", NEW, False, None, None, False)]


def test_reviews_are_recent_known_and_unique(bronze, wide_seed):
    at = dt.datetime(2026, 1, 1)
    rows = bronze(
        ("steam_reviews", "570", DAY, page(review(1, NEW), review(2, NEW, up=False), review(8, OLD)), at),
        ("steam_reviews", "570", DAY, page(review(2, NEW, up=True), review(3, NEW)), at + dt.timedelta(1)),
        ("steam_reviews", "99999", DAY, page(review(4, NEW)), at),
        ("steam_reviews", "x", DAY, page(review(5, NEW)), at),
    )
    assert rows_of(reviews.reviews_batch(rows, wide_seed), "review_id", "voted_up", "game_id") == [
        ("1", True, "dota-2"), ("2", True, "dota-2"), ("3", True, "dota-2"),
    ]


def test_review_days(spark):
    ts = 1709251200  # 2024-03-01
    rows = [("g", ts, True), ("g", ts + 5, True), ("g", ts + 86399, False), ("g", ts + 86400, True), (None, ts, True), ("g", None, True)]
    frame = spark.createDataFrame(rows, "game_id string, review_ts bigint, voted_up boolean")
    assert rows_of(reviews.reviews_daily(frame), "game_id", F.col("date").cast("string"), "reviews_posted", "reviews_positive_share") == [
        ("g", "2024-03-01", 3, 0.6667), ("g", "2024-03-02", 1, 1.0),
    ]


def test_estimates(bronze, wide_seed):
    rows = bronze(
        ("steamspy_snapshot", "570", DAY, {"owners": "10,000,000 .. 20,000,000"}),
        ("steamspy_snapshot", "7", DAY, {"owners": "many"}), ("steamspy_snapshot", "7", DAY, {}), ("steamspy_snapshot", "7", DAY, "{bad"),
        ("gamalytic", "570", DAY, {"revenue": 1.2e9, "copiesSold": 50000000.9}),
        ("gamalytic", "570", DAY, {"revenue": 2, "copiesSold": None}),  # landed later: replaces the one above
        ("gamalytic", "7", DAY, {"revenue": "n/a", "copiesSold": 5}),
        ("gamalytic", "7", "2024-03-02", {"price": 1}), ("gamalytic", "7", None, {"revenue": 1}),
        ("gamalytic", "8", DAY, {"revenue": "n/a"}), ("gamalytic", "8", "2024-03-03", {"revenue": True, "copiesSold": 7}),
        ("gamalytic", "99999", DAY, {"revenue": 1}), ("twitch_helix", "570", DAY, {"revenue": 1}),
    )
    got = rows_of(estimates.estimates_batch(rows, wide_seed), "game_id", "est_source", "est_owners_low", "est_owners_high", "est_units_lifetime", "est_revenue_lifetime_usd")
    assert got == [
        ("blank", "gamalytic", None, None, 5, None),
        ("dota-2", "gamalytic", None, None, None, 2.0),
        ("dota-2", "steamspy", 10_000_000, 20_000_000, None, None),
        ("zed", "gamalytic", None, None, 7, None),
        ("zed", "gamalytic", None, None, None, None),
    ]


def test_newest_estimate_ignores_source_and_nulls(spark):
    rows = [("a", dt.date(2024, 1, 1), 100.0, "gamalytic"), ("a", dt.date(2024, 6, 1), 500.0, "gamalytic"),
            ("b", dt.date(2024, 1, 1), 100.0, "gamalytic"), ("b", dt.date(2024, 1, 1), None, "steamspy")]
    frame = spark.createDataFrame(rows, "game_id string, snapshot_date date, est_revenue_lifetime_usd double, est_source string")
    frame = schemas.conform(frame, schemas.ESTIMATES)
    assert rows_of(estimates.latest_estimates(frame), "game_id", "est_revenue_lifetime_usd") == [("a", 500.0), ("b", None)]


def test_the_two_engagement_upserts_commute_and_are_idempotent(spark, bronze, wide_seed):
    snapshots = engagement.engagement_batch(
        bronze(("twitch_helix", "Dota 2", DAY, {"viewers": 10}), ("reddit", "DotA2", "2024-03-02", {"posts_today": 3})), wide_seed, F.lit("2026-01-01")
    )
    days = spark.createDataFrame(
        [("dota-2", dt.date(2024, 3, 1), 4, 0.5), ("fortnite", dt.date(2024, 3, 1), 1, 1.0)],
        "game_id string, date date, reviews_posted bigint, reviews_positive_share double",
    )
    empty = spark.createDataFrame([], schemas.ENGAGEMENT)
    polled = lambda t: upsert(t, snapshots, engagement.ENGAGEMENT_KEYS, engagement.SNAPSHOT_RULES)
    reviewed = lambda t: upsert(t, days, engagement.ENGAGEMENT_KEYS, reviews.REVIEW_DAY_RULES)
    columns = schemas.columns(schemas.ENGAGEMENT)
    one, other = rows_of(reviewed(polled(empty)), *columns), rows_of(polled(reviewed(empty)), *columns)
    assert one == other and len(one) == 3
    assert rows_of(polled(polled(empty)), *columns) == rows_of(polled(empty), *columns)
    assert rows_of(reviewed(reviewed(empty)), *columns) == rows_of(reviewed(empty), *columns)
    assert {r[0]: r[-1] for r in one}["fortnite"] is None  # inserted by the review job: no arrival time


def test_no_payload_ends_the_job(bronze, seed):
    from titlepulse.plans.engagement import engagement_daily

    rows = bronze(
        ("twitch_helix", "Fortnite", "2024-01-01", '{"viewers":9000000000000000000,"channels":1e30}'),
        ("twitch_helix", "Fortnite", "2024-01-01", '{"viewers":9000000000000000000,"channels":1}'),
        ("google_trends", "Fortnite", "2024-01-02", '{"trends_index":2e12}'),
        ("reddit", "FortNiteBR", "2024-01-02", '{"subscribers":5}'),
    )
    got = {str(r["date"]): r for r in engagement_daily(rows, seed).collect()}
    assert got["2024-01-01"]["twitch_avg_viewers"] == 9e18 and got["2024-01-01"]["twitch_avg_channels"] == 5e29
    assert (got["2024-01-02"]["trends_index"], got["2024-01-02"]["reddit_subscribers"]) == (2e12, 5)
