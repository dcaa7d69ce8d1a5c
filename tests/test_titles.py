import datetime as dt
import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse import schemas
from titlepulse.plans import catalogue, questions, titles
from titlepulse.sources.landing import read_landing, type_envelopes

GOLDEN = [
    # appid, name, free, price, mac, linux, genres, date
    (220, "Half-Life 2", False, 999, True, True, ["Action"], "16 Nov, 2004"),
    (570, "Dota 2", True, None, True, True, ["MOBA", "Free To Play"], "9 Jul, 2013"),
    (413150, "Stardew Valley", False, 1499, True, True, ["Indie", "RPG", "Simulation"], "26 Feb, 2016"),
    (1086940, "Baldur's Gate 3", False, 5999, True, False, ["RPG", "Adventure"], "3 Aug, 2023"),
    (105600, "Terraria", False, 999, True, True, ["Action", "Indie"], "16 May, 2011"),
]


def body(appid, name, free, price, mac, linux, genres, date):
    data = {
        "steam_appid": appid,
        "name": name,
        "is_free": free,
        "platforms": {"windows": True, "mac": mac, "linux": linux},
        "genres": [{"description": g} for g in genres],
        "release_date": {"date": date},
    }
    if price is not None:
        data["price_overview"] = {"final": price, "currency": "USD"}
    return {str(appid): {"success": True, "data": data}}


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    """The store rows of a landing folder, through the reader."""
    folder = tmp_path_factory.mktemp("landing")
    payloads = [body(*g) for g in GOLDEN] + [{"99999": {"success": False}}]
    with open(folder / "apps.jsonl", "w") as out:
        for n, payload in enumerate(payloads):
            envelope = {"source": "steam_store", "ingested_at": f"2026-05-01T12:00:0{n}+00:00", "payload": json.dumps(payload)}
            out.write(json.dumps(envelope) + "\n")
    return type_envelopes(read_landing(spark, str(folder)), "b1")


def parse(bronze, *payloads):
    return titles.store_titles(bronze(*[("steam_store", None, None, p) for p in payloads]))


def wrap(appid, **data):
    return {str(appid): {"success": True, "data": {"steam_appid": appid, **data}}}


def test_landing_rows_without_key_or_date(golden):
    assert golden.columns == schemas.columns(schemas.BRONZE)
    assert golden.count() == 6
    assert golden.where("entity_key is null and extract_date is null and batch_id = 'b1'").count() == 6
    assert golden.agg(F.min("ingested_at")).first()[0] == dt.datetime(2026, 5, 1, 12, 0, 0)


def test_golden_store_rows(golden):
    got = rows_of(
        titles.store_titles(golden), "appid", "name", "release_year", "is_free", "price_cents",
        "supports_windows", "supports_mac", "supports_linux", "primary_genre", "genre_list",
    )
    want = [
        (a, n, int(d[-4:]), f, p or 0, True, m, l, g[0], g) for a, n, f, p, m, l, g, d in GOLDEN
    ]
    assert got == sorted(want, key=lambda r: str(r[0]))


def test_golden_catalogue(golden, spark):
    dimension = titles.assemble_titles(titles.store_titles(golden), spark.createDataFrame([], schemas.SEED))
    platforms = rows_of(catalogue.platform_trends(dimension), *schemas.columns(schemas.PLATFORM_TRENDS))
    prices = {2004: 999.0, 2011: 999.0, 2013: 0.0, 2016: 1499.0, 2023: 5999.0}
    want = [
        (y, p, 1, 1.0 if y == 2013 else 0.0, prices[y])
        for y in prices for p in ("linux", "mac", "windows") if (y, p) != (2023, "linux")
    ]
    assert platforms == sorted(want)
    genres = rows_of(catalogue.genre_trends(dimension), *schemas.columns(schemas.GENRE_TRENDS))
    named = {2004: "Action", 2011: "Action", 2013: "MOBA", 2016: "Indie", 2023: "RPG"}
    assert genres == [(y, named[y], 1, 1.0, prices[y]) for y in sorted(prices)]
    assert rows_of(questions.top_genres(catalogue.genre_trends(dimension)), "primary_genre", "title_count") == [("RPG", 1)]


def test_unusable_payloads(bronze):
    bad = [
        "{not json", "[1]", "5", "", None, "{}", {"1": {"success": False, "data": {"steam_appid": 1, "name": "x"}}},
        wrap(7, is_free=True), wrap(7, name="  "), wrap(7, name=5), {"7": {"success": True, "data": [1]}},
        {"7": {"success": True, "data": {"steam_appid": "7", "name": "x"}}}, {"7": True},
        {"7": {"success": True, "data": {"steam_appid": 7.5, "name": "x"}}},
    ]
    assert parse(bronze, *bad).count() == 0


def test_bare_body_and_first_key(bronze):
    bare = {"success": 1, "data": {"steam_appid": 9, "name": " Nine "}}
    two = {"b": {"success": True, "data": {"steam_appid": 2, "name": "b"}}, "a": {"success": True, "data": {"steam_appid": 1, "name": "a"}}}
    assert rows_of(parse(bronze, bare, two), "appid", "name") == [(2, "b"), (9, "Nine")]


def test_field_rules(bronze):
    cases = [
        (wrap(1, name="x", genres=[]), "genre_list", ["Unknown"]),
        (wrap(1, name="x"), "primary_genre", "Unknown"),
        (wrap(1, name="x", genres=[{"description": " "}, " A ", {"id": 1}, 5, {"description": "B"}]), "genre_list", ["A", "B"]),
        (wrap(1, name="x", price_overview={"final": 999.9}), "price_cents", 999),
        (wrap(1, name="x", price_overview={"final": "999"}), "price_cents", 0),
        (wrap(1, name="x", is_free=1, price_overview={"final": 5}), "price_cents", 0),
        (wrap(1, name="x"), "is_free", False),
        (wrap(1, name="x", platforms={"windows": 1}), "supports_windows", True),
        (wrap(1, name="x", platforms=7), "supports_windows", False),
        (wrap(1, name="x", release_date=2015), "release_year", 2015),
        (wrap(1, name="x", release_date=1492), "release_year", None),
        (wrap(1, name="x", release_date="10 Mar, 2017"), "release_year", 2017),
        (wrap(1, name="x", release_date={"date": "Q4 2023"}), "release_year", 2023),
        (wrap(1, name="x", release_date={"date": 2023}), "release_year", None),
        (wrap(1, name="x", release_date=None), "release_year", None),
    ]
    for payload, column, want in cases:
        assert parse(bronze, payload).first()[column] == want, (payload, column)


def test_last_ingested_row_per_store_id(bronze):
    rows = parse(bronze, wrap(1, name="old"), wrap(2, name="two"), wrap(1, name="new"))
    assert rows_of(titles.latest_store_titles(rows), "appid", "name") == [(1, "new"), (2, "two")]


def test_assembly(bronze, seed):
    store = parse(bronze, wrap(570, name="DOTA", release_date="2013"), wrap(999, name="Some Indie Game"))
    out = {r["game_id"]: r for r in titles.assemble_titles(store, seed).collect()}
    assert set(out) == {"fortnite", "dota-2", "some-indie-game"}
    dota, fortnite, indie = out["dota-2"], out["fortnite"], out["some-indie-game"]
    assert (dota["name"], dota["on_steam"], dota["release_year"], dota["subreddit"]) == ("Dota 2", True, 2013, "DotA2")
    assert (fortnite["on_steam"], fortnite["steam_appid"], fortnite["release_year"]) == (False, None, None)
    assert (fortnite["supports_windows"], fortnite["supports_mac"], fortnite["genre_list"]) == (True, None, [])
    assert (fortnite["storefronts"], fortnite["wikipedia_article"]) == (["epic"], "Fortnite")
    assert (indie["storefronts"], indie["twitch_category"], indie["trends_term"]) == (["steam"], "Some Indie Game", "Some Indie Game")
    assert (indie["wikipedia_article"], indie["subreddit"], indie["steam_appid"]) == (None, None, 999)


def test_seeded_store_title_without_payload(spark, seed, bronze):
    row = titles.titles_batch(bronze(("reddit", "x", None, "{}")), seed, F.lit("2026-01-01")).where("game_id='dota-2'").first()
    assert (row["on_steam"], row["steam_appid"], row["release_year"], row["source"]) == (True, 570, None, "steam_store")


def test_unseeded_store_row_with_the_slug_of_a_seed_title(bronze, seed):
    store = parse(bronze, wrap(5, name="FORTNITE!", platforms={"windows": False}))
    row = titles.assemble_titles(store, seed).where("game_id='fortnite'").first()
    assert (row["name"], row["steam_appid"], row["on_steam"], row["storefronts"]) == ("FORTNITE!", 5, True, ["steam"])
    assert (row["twitch_category"], row["subreddit"], row["supports_windows"]) == ("Fortnite", "FortNiteBR", False)


def test_catalogue_counts(spark):
    rows = [
        ("A", 2020, False, 1999, True, True, False, "Action"), ("B", 2020, True, 0, True, False, True, "Action"),
        ("C", 2020, False, 999, True, False, False, "Indie"), ("D", 2021, False, 500, True, False, False, "RPG"),
        ("E", None, False, 500, True, True, True, "RPG"), ("F", 2021, False, None, True, False, False, None),
    ]
    ddl = "game_id string, release_year int, is_free boolean, price_cents int, supports_windows boolean, supports_mac boolean, supports_linux boolean, primary_genre string"
    frame = spark.createDataFrame(rows, ddl)
    got = {(r[0], r[1]): tuple(r)[2:] for r in catalogue.platform_trends(frame).collect()}
    assert got[(2020, "windows")] == (3, 0.3333, 999.33)
    assert got[(2020, "mac")][0] == got[(2020, "linux")][0] == 1
    assert got[(2021, "windows")] == (2, 0.0, 500.0)
    assert len(got) == 4
    genres = {(r[0], r[1]): tuple(r)[2:] for r in catalogue.genre_trends(frame).collect()}
    assert genres[(2020, "Action")] == (2, 0.6667, 999.5)
    assert genres[(2020, "Indie")] == (1, 0.3333, 999.0)
    assert genres[(2021, "Unknown")] == (1, 0.5, None)
    empty = frame.limit(0)
    assert catalogue.platform_trends(empty).count() == catalogue.genre_trends(empty).count() == 0


def test_large_prices_and_blank_names(bronze):
    import json

    from titlepulse.plans.titles import store_titles

    def body(appid, final, name="A", genre="Action\t"):
        return json.dumps({"success": True, "data": {"steam_appid": appid, "name": name, "price_overview": {"final": final}, "genres": [genre]}})

    rows = bronze(*[("steam_store", None, None, t) for t in (body(1, 3_000_000_000), body(2, 1e30), body(3, 5, "\t"), body(4, None))])
    got = {r["appid"]: (r["price_cents"], r["primary_genre"]) for r in store_titles(rows).collect()}
    assert got == {1: (3_000_000_000, "Action"), 2: (None, "Action"), 4: (0, "Action")}
