import datetime as dt
import json

from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse import schemas
from titlepulse.plans import checks, landing_shapes


def test_stream_summary(spark):
    rows = [("a", 1, 1000), ("a", 2, 300), ("a", 3, 5), ("b", 4, 10), ("b", 5, None), ("b", 6, -5)]
    streams = spark.createDataFrame(rows, "category string, id int, viewer_count bigint")
    polls = spark.createDataFrame([("a",), ("b",), ("empty",)], "category string")
    assert rows_of(landing_shapes.summarize_streams(streams, polls, ["category"]), "category", "viewers", "channels", "peak_stream_viewers") == [
        ("a", 1305, 3, 1000), ("b", 10, 1, 10), ("empty", 0, 0, 0),
    ]
    capped = landing_shapes.capped_summary(streams, ["category"], ["id"], 2)
    assert rows_of(capped, "category", "viewers", "channels", "peak_stream_viewers", "truncated") == [
        ("a", 1300, 2, 1000, True), ("b", 10, 1, 10, True),
    ]
    whole = landing_shapes.capped_summary(streams, ["category"], ["id"])
    assert rows_of(whole, "category", "viewers", "channels", "truncated") == [("a", 1305, 3, False), ("b", 10, 1, False)]
    exact = landing_shapes.capped_summary(streams, ["category"], ["id"], 3)
    assert [r["truncated"] for r in exact.collect()] == [False, False]


def test_posts_of_day(spark):
    day = 1709251200
    rows = [("c", 1, day + 5), ("c", 2, day - 5), ("c", 3, day + 86399), ("c", 4, None), ("d", 5, day - 1)]
    posts = spark.createDataFrame(rows, "community string, id int, created_utc bigint")
    communities = spark.createDataFrame([("c",), ("d",), ("none",)], "community string")
    on = F.lit("2024-03-01").cast("date")
    assert rows_of(landing_shapes.posts_of_day(posts, communities, on, ["id"]), "community", "posts_today") == [("c", 2), ("d", 0), ("none", 0)]
    assert rows_of(landing_shapes.posts_of_day(posts, communities, on, ["id"], 1), "community", "posts_today") == [("c", 1), ("d", 0), ("none", 0)]
    many = spark.createDataFrame([("e", n, day + n) for n in range(250)], "community string, id int, created_utc bigint")
    assert rows_of(landing_shapes.posts_of_day(many, many, on), "community", "posts_today") == [("e", 250)]


def test_pageviews(spark):
    items = [{"timestamp": "2024030100", "views": 5}, {"timestamp": "2024", "views": 5}, {"timestamp": 2024030100, "views": 5},
             {"timestamp": "2024030200", "views": "5"}, {"views": 5}, 7, {"timestamp": "20240303", "views": 0}]
    frame = spark.createDataFrame([("A", json.dumps({"items": items})), ("B", "{}"), ("C", "{bad")], "article string, payload string")
    assert rows_of(landing_shapes.unpack_pageviews(frame), "article", F.col("date").cast("string"), "views") == [("A", "2024-03-01", 5), ("A", "2024-03-03", 0)]


def test_rescale_and_expand(spark):
    w = [dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2024, 1, 21)]
    terms = spark.createDataFrame([("t", w[0], 1.0), ("t", w[1], 5.0), ("t", w[2], None)], "term string, week date, value double")
    anchor = spark.createDataFrame([(w[0], 3.0), (w[1], 0.0), (w[2], 5.0)], "week date, value double")
    weekly = landing_shapes.rescale_to_anchor(terms, anchor)
    assert rows_of(weekly, "term", F.col("week").cast("string"), "trends_index") == [("t", "2024-01-07", 33.33)]
    days = landing_shapes.expand_weeks(weekly, F.lit("2024-01-09").cast("date"))
    assert rows_of(days, F.col("date").cast("string"), "trends_index") == [("2024-01-07", 33.33), ("2024-01-08", 33.33), ("2024-01-09", 33.33)]
    assert landing_shapes.expand_weeks(weekly, F.lit("2024-01-01").cast("date")).count() == 0


def test_every_review_page_is_dated(spark):
    new, old = 1704067200, 1546300800

    def page(cursor, *times):
        return json.dumps({"reviews": [{"timestamp_created": t} for t in times], "cursor": cursor})

    rows = [
        ("crosses", 0, "*", page("a", new, new + 9)), ("crosses", 1, "a", page("b", new, old)), ("crosses", 2, "b", page("c", old)),
        ("empty", 0, "*", page("a", new)), ("empty", 1, "a", page("b")), ("empty", 2, "b", page("c", new)),
        ("ends", 0, "*", page("", new)), ("ends", 1, "", page("x", new)),
        ("repeats", 0, "*", page("a", new)), ("repeats", 1, "a", page("a", new)), ("repeats", 2, "a", page("a", new)),
        ("runs", 0, "*", page("a", new)), ("runs", 1, "a", json.dumps({"reviews": [{"id": 1}, {"timestamp_created": new}], "cursor": "b"})),
    ]
    frame = spark.createDataFrame(rows, "appid string, page int, requested string, payload string")
    got = rows_of(landing_shapes.date_review_pages(frame), "appid", "page", F.col("extract_date").cast("string"))
    assert got == [
        ("crosses", 0, "2024-01-01"), ("crosses", 1, "2019-01-01"), ("crosses", 2, "2019-01-01"), ("empty", 0, "2024-01-01"),
        ("empty", 2, "2024-01-01"), ("ends", 0, "2024-01-01"), ("ends", 1, "2024-01-01"), ("repeats", 0, "2024-01-01"), ("repeats", 1, "2024-01-01"),
        ("repeats", 2, "2024-01-01"), ("runs", 0, "2024-01-01"), ("runs", 1, "2024-01-01"),
    ]


def test_keyed_objects_in_document_order(spark):
    text = '{"30":{"a":1},"10":{"a":2},"20":{"a":3}}'
    frame = spark.createDataFrame([(text,), ("{bad",), ("[1]",)], "payload string")
    assert rows_of(landing_shapes.unpack_keyed(frame, 2), "position", "key", "payload") == [(0, "30", '{"30":{"a":1}}'), (1, "10", '{"10":{"a":2}}')]
    assert landing_shapes.unpack_keyed(frame, 500).count() == 3
    many = spark.createDataFrame([(json.dumps({f"k{n}": {"a": n} for n in range(300)}),)], "payload string")
    assert landing_shapes.unpack_keyed(many).count() == 300 and landing_shapes.unpack_keyed(many, 250).count() == 250


def test_unresolved_keys(bronze, seed):
    rows = bronze(("reddit", "DotA2", None, "{}"), ("reddit", "other", None, "{}"), ("steam_store", None, None, "{}"), ("reddit", "", None, "{}"))
    got = rows_of(landing_shapes.unresolved_keys(rows, seed).where("source = 'reddit'"), "entity_key", "problem")
    assert got == [("FortNiteBR", "no data"), ("other", "not tracked")]
    rows = bronze(("steam_ccu", "0570", None, "{}"), ("steam_ccu", "x1", None, "{}"))
    got = rows_of(landing_shapes.unresolved_keys(rows, seed).where("source = 'steam_ccu'"), "entity_key", "problem")
    assert got == [("x1", "not tracked")]


def test_reports(spark, seed):
    ddl = schemas.ENGAGEMENT
    days = [("a", dt.date(2024, 1, d), 1.0 if d % 2 else None) for d in range(1, 20)]
    daily = schemas.conform(spark.createDataFrame(days, "game_id string, date date, twitch_avg_viewers double"), ddl)
    coverage = checks.signal_coverage(daily).collect()
    assert len(coverage) == 14 and coverage[0]["date"] == dt.date(2024, 1, 19)
    assert (coverage[0]["with_twitch"], coverage[1]["with_twitch"], coverage[0]["titles"]) == (1, 0, 1)
    genres = spark.createDataFrame([(2020, 0.6667), (2020, 0.3333), (2021, 0.5)], "release_year int, release_share double")
    assert rows_of(checks.share_sums(genres), "release_year", "share_sum", "balanced") == [(2020, 1.0, True), (2021, 0.5, False)]
    ratios = spark.createDataFrame([("a", "m", None), ("b", "m", 1.0), ("c", "m", 5.0)], "game_id string, month string, revenue_per_avg_viewer double")
    assert [r["game_id"] for r in checks.best_revenue_ratios(ratios).collect()] == ["c", "b", "a"]
    leaders = spark.createDataFrame([("a", "m", None), ("b", "m", 2), ("c", "m", 1)], "game_id string, month string, rank int")
    assert [r["game_id"] for r in checks.leaders(leaders).collect()] == ["c", "b", "a"]
