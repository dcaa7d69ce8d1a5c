import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse.operators import upsert as rules
from titlepulse.operators.latest import latest_by
from titlepulse.operators.lookup import fits_broadcast, lookup_join
from titlepulse.operators.ranking import rank_within, top_within
from titlepulse.operators.upsert import upsert

def order():
    return [F.col("v").desc(), F.col("id").asc()]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many ties, and groups of one row."""
    generator = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"g{generator.randrange(200)}", generator.randrange(40)) for i in range(6000)]
    return spark.createDataFrame(rows, "id int, g string, v int").repartition(7), rows


def expected_ranks(rows):
    out = {}
    for group in {r[1] for r in rows}:
        members = sorted((r for r in rows if r[1] == group), key=lambda r: (-r[2], r[0]))
        out |= {r[0]: n for n, r in enumerate(members, 1)}
    return out


def test_rank_within_matches_sorting_each_group(skewed):
    frame, rows = skewed
    got = {r["id"]: r["rank"] for r in rank_within(frame, ["g"], order()).collect()}
    assert got == expected_ranks(rows)


def test_a_large_group_is_ranked_by_several_tasks(skewed, spark):
    frame, rows = skewed
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # else a group this small ends up in one slice
    try:
        ranked = rank_within(frame, ["g"], order())
        slices = frame.repartitionByRange("g", *order()).withColumn("s", F.spark_partition_id()).where("g = 'hot'")
        assert slices.agg(F.countDistinct("s")).first()[0] > 1
        assert {r["id"]: r["rank"] for r in ranked.collect()} == expected_ranks(rows)
    finally:
        spark.conf.set(merge, "true")


def test_top_within_matches_sorting_each_group(skewed):
    frame, rows = skewed
    got = {r["id"]: r["rank"] for r in top_within(frame, ["g"], order(), 10).collect()}
    assert got == {i: n for i, n in expected_ranks(rows).items() if n <= 10}


def test_top_within_cuts_groups_before_each_shuffle(skewed):
    frame, _ = skewed
    plan = top_within(frame, ["g"], order(), 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4  # before and after each of the two shuffles


def test_latest_by(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w")], "k string, t int, v string")
    assert rows_of(latest_by(frame, ["k"], [F.col("t")]), "k", "t", "v") == [("a", 2, "z"), ("b", None, "w")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_is_the_same_by_broadcast_and_by_shuffle(spark, how):
    facts = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i % 5) for i in range(3000)], "k string, v int").repartition(5)
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 3000, 2)], "k string, w int")
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, max_rows=10) and not fits_broadcast(lookup, max_bytes=100)
    small = lookup_join(facts, lookup, ["k"], how)
    large = lookup_join(facts, lookup, ["k"], how, max_rows=10)
    assert rows_of(small, "k", "v", "w") == rows_of(large, "k", "v", "w") == rows_of(facts.join(lookup, ["k"], how), "k", "v", "w")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_the_size_check_brings_no_rows_together(spark):
    from pyspark.sql import functions as F

    from titlepulse.operators import lookup as module

    seen = []
    frame = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.array(F.lit("x")).alias("v")).repartition(4)

    class Spy(type(frame)):
        def agg(self, *columns):
            out = super().agg(*columns)
            seen.append(out._jdf.queryExecution().executedPlan().toString())
            return out

    frame.__class__ = Spy
    assert module.fits_broadcast(frame)
    below = seen[0].split("SinglePartition")[1]
    assert "partial_count" in below and "Limit" not in below


OLD = [("a", 1, 1, True, ["x"], 1), ("b", 2, 2, None, ["y"], 2), ("c", 3, None, False, None, 3), (None, 9, 9, True, [], 9)]
NEW = [("a", None, None, False, [], 10), ("b", 20, 20, True, ["z"], 20), ("d", 40, 40, None, [], 40), (None, 8, 8, None, None, 8), (None, 8, 8, None, None, 8)]
DDL = "k string, batch int, some int, either boolean, list array<string>, mine int"
RULES = {"batch": rules.BATCH, "some": rules.COALESCE, "either": rules.EITHER, "list": rules.NONEMPTY, "mine": rules.KEEP}


def test_upsert_rules(spark):
    merged = upsert(spark.createDataFrame(OLD, DDL), spark.createDataFrame(NEW, DDL), ["k"], RULES)
    got = [tuple(r) for r in merged.collect()]
    assert sorted(r for r in got if r[0]) == [
        ("a", None, 1, True, ["x"], 1), ("b", 20, 20, True, ["z"], 2),
        ("c", 3, None, False, None, 3), ("d", 40, 40, None, [], 40),
    ]
    assert sorted(r[1] for r in got if r[0] is None) == [8, 8, 9]  # NULL keys match nothing


def test_upsert_is_idempotent_on_keyed_rows(spark):
    old, new = spark.createDataFrame(OLD[:3], DDL), spark.createDataFrame(NEW[:3], DDL)
    once = upsert(old, new, ["k"], RULES)
    assert rows_of(upsert(once, new, ["k"], RULES), *once.columns) == rows_of(once, *once.columns)


def test_upsert_refuses_a_batch_with_repeated_keys(spark):
    new = spark.createDataFrame([NEW[0], NEW[0]], DDL)
    with pytest.raises(Exception, match="several rows for key"):
        upsert(spark.createDataFrame(OLD, DDL), new, ["k"], RULES).collect()


def test_upsert_batch_with_fewer_columns_leaves_the_rest(spark):
    merged = upsert(spark.createDataFrame(OLD[:2], DDL), spark.createDataFrame([("a", 7), ("z", 8)], "k string, batch int"), ["k"], {"batch": rules.BATCH})
    assert rows_of(merged, "k", "batch", "some", "mine") == [("a", 7, 1, 1), ("b", 2, 2, 2), ("z", 8, None, None)]


def test_upsert_checks_keys_without_a_shuffle_of_its_own(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(spark.createDataFrame(OLD, DDL), spark.createDataFrame(NEW, DDL), ["k"], RULES)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
