"""The shape of the physical plans, and the registered queries against their SQL on the smallest scale."""

import os
import re

import pytest

import __spark_entry__ as entry
from testbed.bindings import Inputs
from testbed.compare import connect, difference
from testbed.queries import QUERIES
from titlepulse.plans import attention, engagement, reviews
from titlepulse.sources.shared import stage

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are absent")

LINKED = [
    "s4_load_seed", "m1_upsert_titles", "m4_upsert_review_days", "p2_release_year", "p16_rounding", "r2_capped_streams",
    "r7_date_review_pages", "j3_title_dimension", "j11_engagement_daily", "j13_reviews", "j17_estimates", "g2_genre_trends",
    "g6_attention_trends", "g7_cohort_split", "g14_revenue_engagement", "q8_off_store_above_store", "d5_seed_report",
]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, FOLDER)


def test_every_query_has_its_sql():
    from testbed.sql_checks import CHECKS

    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
    ids = {name.split("_")[0] for name in entry.queries()}
    wanted = {f"{letter}{n}" for letter, count in zip("smprjgqd", (8, 5, 18, 9, 17, 14, 11, 7)) for n in range(1, count + 1)}
    assert wanted <= ids


@needs_data
@pytest.mark.parametrize("name", LINKED)
def test_query_equals_its_sql(spark, name):
    assert difference(spark, connect(FOLDER), name, FOLDER) is None


@needs_data
def test_nothing_runs_in_python(spark):
    for name in ("j3_title_dimension", "j11_engagement_daily", "j13_reviews", "j17_estimates", "g7_cohort_split", "g13_title_monthly"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert not re.search("Python|Pandas|Arrow", text), name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


@needs_data
def test_snapshots_shuffle_once_and_parse_once(inputs):
    bronze = stage(inputs.snapshots, "bronze")
    text = plan(engagement.engagement_daily(bronze, inputs.seed))
    facts = text[: text.index("BroadcastExchange")]  # the other side is the crosswalk
    assert facts.count("Exchange hashpartitioning") == 1
    assert text.count("from_json") == 1
    assert "PushedFilters: [In(source" in text


@needs_data
def test_review_pages_are_parsed_once(inputs):
    text = plan(reviews.explode_reviews(stage(inputs.review_pages, "pages").select("entity_key", "payload")))
    assert text.count("from_json") == 2  # the page, and each review
    assert "Exchange" not in text


@needs_data
def test_attention_moves_a_title_once_after_the_weekly_rollup(inputs):
    daily = stage(inputs.engagement, "daily")
    text = plan(attention.attention_trends(daily))
    assert text.count("Exchange hashpartitioning") == 2  # the rollup by title and week, then by title
    assert "reviews_posted" not in text.split("ReadSchema")[1]
