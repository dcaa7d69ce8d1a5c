"""The landing folder through all jobs to the derived tables and the questions."""

import datetime as dt
import json
import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse import jobs, schemas
from titlepulse.plans import checks, questions
from titlepulse.sources import landing
from titlepulse.sources.seed import crosswalk, read_seed
from titlepulse.sources.tables import Tables
from titlepulse.streaming.landing_stream import ingest_new_files

HEADER = "game_id,name,steam_appid,twitch_category,wikipedia_article,subreddit,trends_term,storefronts"
NOW = dt.datetime(2026, 5, 2, tzinfo=dt.timezone.utc)


def envelope(source, key, day, payload, second=0):
    return {"source": source, "entity_key": key, "extract_date": day, "ingested_at": f"2026-05-01T12:00:{second:02d}+00:00", "payload": json.dumps(payload)}


def land(folder, name, rows):
    with open(folder / name, "w") as out:
        out.writelines(json.dumps(row) + "\n" for row in rows)


@pytest.fixture(scope="module")
def seed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("seed") / "seed.csv"
    path.write_text(
        HEADER + '\nfortnite,Fortnite,,Fortnite,Fortnite,FortNiteBR,Fortnite,epic\n'
        'dota-2,"Dota 2",570,Dota 2,Dota_2,DotA2,Dota 2,steam | |gog\n,Missing Id,1,x,y,z,w,steam\nno-name,,2,x,y,z,w,steam\n'
    )
    return read_seed(spark, str(path))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    store = {"570": {"success": True, "data": {"steam_appid": 570, "name": "Dota 2", "is_free": True, "platforms": {"windows": True}, "genres": [{"description": "MOBA"}], "release_date": {"date": "9 Jul, 2013"}}}}
    land(folder, "store.jsonl", [{"source": "steam_store", "ingested_at": "2026-05-01T12:00:00+00:00", "payload": json.dumps(store)}])
    days = [("2024-01-01", 100, 50), ("2024-01-08", 200, 60), ("2024-01-15", 100, 50), ("2024-02-05", 400, 10)]
    land(folder, "streams.jsonl", [
        envelope("twitch_helix", title, day, {"viewers": v, "channels": 1})
        for day, fortnite, dota in days for title, v in (("Fortnite", fortnite), ("Dota 2", dota))
    ])
    ts = 1704067200
    land(folder, "reviews.jsonl", [envelope("steam_reviews", "570", "2024-01-01", {"success": 1, "reviews": [
        {"recommendationid": str(n), "timestamp_created": ts + n, "voted_up": n % 2 == 0} for n in range(3)], "cursor": "c"})])
    land(folder, "estimates.jsonl", [envelope("gamalytic", "570", "2024-03-01", {"revenue": 1000.0, "copiesSold": 10}), envelope("steamspy", "570", None, {"570": {}})])
    return folder


@pytest.fixture(scope="module")
def tables(spark, seed, folder, tmp_path_factory):
    tables = Tables(spark, str(tmp_path_factory.mktemp("lake")))
    jobs.run_all(tables, seed, str(folder), "batch-1", NOW)
    return tables


def content(tables, name, ddl, *drop):
    return rows_of(tables.read(name, ddl), *[c for c in schemas.columns(ddl) if c not in drop])


ALL = {
    "silver_titles": schemas.TITLES, "silver_engagement_daily": schemas.ENGAGEMENT, "silver_reviews": schemas.REVIEWS,
    "silver_sales_estimates": schemas.ESTIMATES, "gold_platform_trends": schemas.PLATFORM_TRENDS, "gold_genre_trends": schemas.GENRE_TRENDS,
    "gold_attention_trends": schemas.ATTENTION_TRENDS, "gold_steam_vs_offsteam": schemas.COHORT_SPLIT,
    "gold_title_monthly": schemas.TITLE_MONTHLY, "gold_revenue_engagement": schemas.REVENUE_ENGAGEMENT,
}


def test_every_table_has_its_contract(tables, spark):
    for name, ddl in ALL.items():
        frame = tables.read(name, ddl)
        want = spark.createDataFrame([], ddl)
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in want.schema], name
        assert frame.count() > 0, name


def test_the_seed_file(seed):
    assert rows_of(seed, "game_id", "name", "steam_appid", "storefronts") == [("dota-2", "Dota 2", 570, ["steam", "gog"]), ("fortnite", "Fortnite", None, ["epic"])]
    report = checks.seed_report(seed, 2, 1).first()
    assert report["usable"] and report["seed_rows"] == 2 and report["off_store_rows"] == 1
    assert not checks.seed_report(seed.unionByName(seed), 2, 1).first()["usable"]


def test_of_two_seed_rows_with_one_key_the_later_wins(spark, tmp_path):
    (tmp_path / "s.csv").write_text(HEADER + "\nzed,Zed,5,,,Shared,,steam\nabe,Abe,5,,,Shared,,steam\n")
    pairs = rows_of(crosswalk(read_seed(spark, str(tmp_path / "s.csv")), ["reddit", "steam_ccu"]), "source", "entity_key", "game_id")
    assert pairs == [("reddit", "Shared", "abe"), ("steam_ccu", "5", "abe")]


def test_results(tables):
    dota = tables.read("silver_titles", schemas.TITLES).where("game_id = 'dota-2'").first()
    assert (dota["release_year"], dota["price_cents"], dota["source"], dota["twitch_category"]) == (2013, 0, "steam_store", "Dota 2")
    assert content(tables, "gold_genre_trends", schemas.GENRE_TRENDS) == [(2013, "MOBA", 1, 1.0, 0.0)]
    daily = tables.read("silver_engagement_daily", schemas.ENGAGEMENT).where("game_id = 'dota-2' and date = '2024-01-01'").first()
    assert (daily["twitch_avg_viewers"], daily["reviews_posted"], daily["reviews_positive_share"]) == (50.0, 3, 0.6667)
    assert content(tables, "gold_title_monthly", schemas.TITLE_MONTHLY) == [
        ("dota-2", "2024-01-01", 53.33, 2, None, 3, 1000.0), ("dota-2", "2024-02-01", 10.0, 2, 0, 0, 1000.0),
        ("fortnite", "2024-01-01", 133.33, 1, None, 0, None), ("fortnite", "2024-02-01", 400.0, 1, 0, 0, None),
    ]
    assert content(tables, "gold_revenue_engagement", schemas.REVENUE_ENGAGEMENT)[0] == ("dota-2", "2024-01-01", 1000.0, 10, 3, 53.33, 18.75)
    monthly, dimension = tables.read("gold_title_monthly", schemas.TITLE_MONTHLY), tables.read("silver_titles", schemas.TITLES)
    assert [r["game_id"] for r in questions.off_store_above_store(monthly, dimension).collect()] == ["fortnite"]
    attention = tables.read("gold_attention_trends", schemas.ATTENTION_TRENDS)
    assert [r["attention_index"] for r in questions.attention_of(attention, "fortnite").collect()] == [None, 200.0, 66.67, 300.0]


def test_running_again_changes_nothing(tables, seed, folder):
    before = {name: content(tables, name, ddl) for name, ddl in ALL.items()}
    jobs.run_all(tables, seed, str(folder), "batch-1", NOW)
    assert {name: content(tables, name, ddl) for name, ddl in ALL.items()} == before
    assert jobs.bronze(tables).count() == 12
    versions = len(tables._versions("silver_titles"))
    tables.expire("silver_titles", 1)
    assert versions == 2 and len(tables._versions("silver_titles")) == 1
    assert content(tables, "silver_titles", schemas.TITLES) == before["silver_titles"]


def test_a_failed_write_leaves_the_table(tables, spark):
    before = content(tables, "silver_reviews", schemas.REVIEWS)
    broken = tables.read("silver_reviews", schemas.REVIEWS).withColumn("language", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.replace("silver_reviews", broken)
    assert content(tables, "silver_reviews", schemas.REVIEWS) == before
    tables.replace("silver_reviews", tables.read("silver_reviews", schemas.REVIEWS))  # the next write is not in its way
    assert content(tables, "silver_reviews", schemas.REVIEWS) == before


def test_stub_rows_do_not_erase_store_metadata(tables, seed, spark):
    from titlepulse.plans import titles

    stub = titles.titles_batch(jobs.bronze(tables).where("false"), seed, F.lit("2026-06-01"))
    tables.upsert("silver_titles", stub, schemas.TITLES, titles.TITLE_KEYS, titles.TITLE_RULES)
    dota = tables.read("silver_titles", schemas.TITLES).where("game_id = 'dota-2'").first()
    assert (dota["release_year"], dota["genre_list"], dota["primary_genre"]) == (2013, ["MOBA"], "MOBA")


def test_scan_reads_only_the_folders_of_its_sources(tables):
    from titlepulse.plans.engagement import scan_sources

    plan = scan_sources(jobs.bronze(tables), ("steam_reviews",))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "batch_id" not in plan.split("ReadSchema")[1]


def test_streaming_reads_each_file_once(spark, folder, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    for _ in range(2):
        ingest_new_files(tables, str(folder), str(tmp_path / "progress")).awaitTermination()
    assert jobs.bronze(tables).count() == 12
    assert rows_of(checks.rows_per_source(jobs.bronze(tables)), "source", "n") == [
        ("gamalytic", 1), ("steam_reviews", 1), ("steam_store", 1), ("steamspy", 1), ("twitch_helix", 8),
    ]


def test_envelopes_survive_the_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("Fortnite", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 5), 7)], "k string, d date, t timestamp, v int")
    landing.write_landing(landing.envelope(rows, "twitch_helix", F.col("k"), F.col("d"), F.col("t"), F.struct(F.col("v").alias("viewers"))), str(tmp_path / "out"))
    back = landing.type_envelopes(landing.read_landing(spark, str(tmp_path / "out"), "*.json"), "b")
    assert rows_of(back, *schemas.columns(schemas.BRONZE)) == [("twitch_helix", "Fortnite", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 5), "b", '{"viewers":7}')]
    twice = back.unionByName(back.withColumn("batch_id", F.lit("c")))
    assert rows_of(landing.drop_repeats(twice), "batch_id") == [("b",)]


def test_bad_dates_in_envelopes_are_null(spark, tmp_path):
    land(tmp_path, "x.jsonl", [{"source": "reddit", "extract_date": "soon", "ingested_at": "later", "payload": "{}"}])
    row = landing.type_envelopes(landing.read_landing(spark, str(tmp_path)), "b").first()
    assert (row["extract_date"], row["ingested_at"], row["source"]) == (None, None, "reddit")


def test_a_second_poll_is_ingested_once(spark, seed, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    (tmp_path / "land").mkdir()
    for n, viewers in enumerate((100, 200)):
        land(tmp_path / "land", f"poll{n}.jsonl", [envelope("twitch_helix", "Fortnite", "2024-01-01", {"viewers": viewers}, n)])
        jobs.ingest(tables, str(tmp_path / "land"))
    assert jobs.ingest(tables, str(tmp_path / "land"), "again") == "again"
    jobs.build_engagement(tables, seed, F.lit("2026-01-01"))
    assert content(tables, "silver_engagement_daily", "game_id string, twitch_avg_viewers double") == [("fortnite", 150.0)]
    jobs.ingest(tables, str(tmp_path / "land"), "again")
    assert jobs.bronze(tables).count() == 2


def test_two_streams_into_one_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    for n in range(2):
        (tmp_path / f"land{n}").mkdir()
        land(tmp_path / f"land{n}", "a.jsonl", [envelope("reddit", f"k{n}", "2024-01-01", {})])
        ingest_new_files(tables, str(tmp_path / f"land{n}"), str(tmp_path / f"progress{n}")).awaitTermination()
    assert rows_of(jobs.bronze(tables), "entity_key") == [("k0",), ("k1",)]


def test_expire_keeps_the_committed_version_and_damage_is_not_empty(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    good = spark.createDataFrame([(1,)], "n int")
    tables.replace("t", good)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            tables.replace("t", good.withColumn("n", F.raise_error(F.lit("lost")).cast("int")))
    tables.expire("t", 2)
    tables.expire("t", 0)
    assert tables.read("t", "n int").count() == 1
    assert tables.read("absent", "n int").count() == 0
    for marker in (tmp_path / "lake/t/_committed").iterdir():
        marker.unlink()
    with pytest.raises(RuntimeError, match="no version was committed"):
        tables.read("t", "n int")
    with pytest.raises(RuntimeError):
        tables.upsert("t", good, "n int", ["n"], {})


def test_a_run_leaves_nothing_staged(spark, seed, folder, tmp_path):
    from titlepulse.sources.shared import shared_folder

    before = set(os.listdir(shared_folder(spark)))
    tables = Tables(spark, str(tmp_path / "lake"))
    for _ in range(3):
        jobs.run_all(tables, seed, str(folder), "b", NOW)
    assert set(os.listdir(shared_folder(spark))) == before
    assert len(tables._versions("gold_title_monthly")) == 2


def test_tables_are_asked_in_sql_by_name(tables, spark):
    jobs.register_views(tables)
    top = spark.sql("""select primary_genre, title_count from gold_genre_trends
                       where release_year = (select max(release_year) from gold_genre_trends) order by title_count desc limit 5""")
    assert rows_of(top, "primary_genre", "title_count") == [("MOBA", 1)]
    off = spark.sql("""with latest as (select m.*, t.on_steam from gold_title_monthly m join silver_titles t using (game_id)
                                       where month = (select max(month) from gold_title_monthly))
                       select game_id from latest where not on_steam and rank < (select min(rank) from latest where on_steam)""")
    assert rows_of(off, "game_id") == [("fortnite",)]


def test_a_store_id_that_is_no_number_fails_the_job(spark, tmp_path):
    from titlepulse.sources.seed import unreadable_ids

    (tmp_path / "s.csv").write_text(HEADER + "\nzed,Zed,10x,,,s,,steam\nabe,\t Abe\t,\t5 ,,,t,,steam\n")
    with pytest.raises(Exception, match="not a store id: 10x"):
        read_seed(spark, str(tmp_path / "s.csv")).collect()
    raw = spark.read.option("header", True).csv(str(tmp_path / "s.csv"))
    assert [r["game_id"] for r in unreadable_ids(raw).collect()] == ["zed"]
    assert rows_of(read_seed(spark, str(tmp_path / "s.csv")).where("game_id = 'abe'"), "name", "steam_appid") == [("Abe", 5)]
