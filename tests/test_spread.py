"""How many rows meet in one task, and what is sent to all of them, where sizes of files mislead."""

import os
import re

import pytest
from pyspark.sql import functions as F

from testbed.bindings import Inputs
from testbed.queries import QUERIES
from titlepulse import schemas
from titlepulse.operators import spread
from titlepulse.operators.lookup import lookup_join
from titlepulse.operators.spread import ROWS, TASKS_PER_CORE, by_rows
from titlepulse.plans import attention, titles
from titlepulse.sources.seed import crosswalk

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are absent")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_titles_of_the_attention_table_are_dealt_to_many_tasks(spark):
    weekly = attention.weekly_engagement(spark.createDataFrame([], schemas.ENGAGEMENT))
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert re.search(rf"hashpartitioning\(game_id#\d+, {tasks}\), REPARTITION_BY_NUM", plan(attention.attention_index(weekly)))


def test_weeks_are_grouped_in_many_tasks_after_one_exchange(spark):
    text = plan(attention.weekly_engagement(spark.createDataFrame([], schemas.ENGAGEMENT)))
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert text.count("Exchange ") == 1
    assert re.search(rf"hashpartitioning\(game_id#\d+, week#\d+, {tasks}\), REPARTITION_BY_NUM", text)
    assert "HashAggregate" not in text[text.index("REPARTITION_BY_NUM") :]


def test_tasks_of_the_attention_table_grow_with_its_days(spark):
    rows = 10 * TASKS_PER_CORE * spark.sparkContext.defaultParallelism * ROWS
    text = plan(attention.attention_trends(spark.createDataFrame([], schemas.ENGAGEMENT), rows=rows))
    assert set(re.findall(r"(\d+)\), REPARTITION_BY_NUM", text)) == {str(rows // ROWS)}


@needs_data
def test_a_task_of_the_attention_queries_gets_no_more_rows_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(spread, "ROWS", 20)
    text = plan(QUERIES["g6_attention_trends"](spark, FOLDER))
    tasks = -(-spark.read.parquet(f"{FOLDER}/lineitem.parquet").count() // 20)
    assert len(re.findall(rf", {tasks}\), REPARTITION_BY_NUM", text)) == 2


@needs_data
def test_engagement_is_grouped_after_one_exchange_of_bounded_tasks(spark):
    text = plan(Inputs(spark, FOLDER).engagement)
    assert text.count("Exchange ") == 1
    assert text.index("HashAggregate") < text.index("REPARTITION_BY_NUM")
    assert "HashAggregate" not in text[text.index("REPARTITION_BY_NUM") :]


def test_by_rows_bounds_the_rows_of_a_task(spark):
    rows = by_rows(spark.range(1000), "id", rows=100)
    assert rows.rdd.getNumPartitions() == 10
    assert by_rows(spark.range(0), "id").count() == 0


def test_a_lookup_beyond_the_bound_is_not_sent_to_all_tasks(spark):
    facts = spark.range(50).withColumn("key", F.col("id") % 7)
    lookup = spark.range(5).select(F.col("id").alias("key"), F.col("id").cast("string").alias("name"))
    joined = lookup_join(facts, lookup, ["key"], "left", max_rows=4)
    assert "Broadcast" not in plan(joined)
    assert joined.where("name is null").count() == 14 and joined.count() == 50
    assert "BroadcastHashJoin" in plan(lookup_join(facts, lookup, ["key"], "left"))


def test_crosswalk_pairs_are_not_sorted_before_they_move(spark, seed):
    text = plan(crosswalk(seed, list(schemas.SOURCE_KEYS)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Aggregate" not in text[text.index("Exchange hashpartitioning") :]


def test_store_payloads_are_dealt_out_before_they_are_parsed(spark):
    body = '{{"{0}":{{"success":true,"data":{{"steam_appid":{0},"name":"t{0}"}}}}}}'
    rows = spark.createDataFrame([(body.format(n),) for n in range(1, 6)], "payload string").withColumn("ingested_at", F.timestamp_seconds(F.lit(0)))
    parsed = titles.store_titles(rows.coalesce(1))
    text = plan(parsed)
    assert text.index("from_json") < text.index("Exchange hashpartitioning(payload")
    assert sorted(row["appid"] for row in parsed.collect()) == [1, 2, 3, 4, 5]
