"""Tables kept in parts: what an upsert reads and writes, and what a commit holds."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from titlepulse.operators.upsert import ADD, BATCH, COALESCE, MOST, upsert
from titlepulse.sources.tables import Tables

DDL = "k string, day date, a bigint, b bigint, note string"
LAYOUT = {"t": {"p_month": "date_format(day, 'yyyy-MM')", "p_bucket": "pmod(xxhash64(k), 3)"}}
KEYS, RULES = ["k", "day"], {"a": BATCH, "b": COALESCE, "note": BATCH}


def frame(spark, rows):
    return spark.createDataFrame([(k, d, a, b, n) for k, d, a, b, n in rows], "k string, d string, a bigint, b bigint, note string").select("k", F.to_date("d").alias("day"), "a", "b", "note")


def some(seed, months, count=60, nulls=True):
    rng = random.Random(seed)
    keys = {(f"k{rng.randrange(9)}", f"2024-{rng.choice(months):02d}-{rng.randint(1, 28):02d}") for _ in range(count)}
    rows = [(k, d, rng.randrange(9), rng.choice([None, 5]), rng.choice(["x", None])) for k, d in sorted(keys)]
    return rows + ([(None, "2024-01-01", 1, 1, "n"), ("k1", None, 1, 1, "n"), ("", "2024-01-02", 1, None, "e")] if nulls else [])


def files(path):
    return {str(f.relative_to(path)): f.read_bytes() for f in path.rglob("*.parquet") if "/data/" in str(f)}


def test_an_upsert_rewrites_only_the_parts_of_its_batch(spark, tmp_path):
    tables, whole = Tables(spark, str(tmp_path), LAYOUT), Tables(spark, str(tmp_path / "whole"), {})
    batches = [some(1, [1, 2, 3]), some(2, [3], 8, nulls=False), some(3, [3, 7], 9)]
    for n, rows in enumerate(batches):
        before = files(tmp_path)
        if n == 1:  # what lies in other months is not even read
            others = [f for f in tmp_path.glob("t/data/p_month=2024-0[12]/*/*/*.parquet")]
            held = {f: f.read_bytes() for f in others}
            for f in others:
                f.write_bytes(b"no parquet")
            for crc in tmp_path.glob("t/data/p_month=2024-0[12]/*/*/.*.crc"):
                crc.unlink()
        for lake in (tables, whole):
            lake.upsert("t", frame(spark, rows), DDL, KEYS, RULES)
        if n == 1:
            for f, data in held.items():
                f.write_bytes(data)
            new = {name for name in files(tmp_path) if name not in before}
            assert new and all("p_month=2024-03" in name for name in new)
            touched = {name.split("p_version")[0] for name in new}
            assert len(touched) < len({name.split("p_version")[0] for name in before})
        assert {name: data for name, data in files(tmp_path).items() if name in before} == before
        assert rows_of(tables.read("t", DDL), *KEYS, "a", "b", "note") == rows_of(whole.read("t", DDL), *KEYS, "a", "b", "note")
    near = tables.read_near("t", DDL, frame(spark, [("k1", "2024-07-01", 0, 0, "")]))
    assert set(near.select(F.month("day")).distinct().toPandas().iloc[:, 0]) <= {7}


def test_a_commit_holds_rows_and_notes_or_neither(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), LAYOUT)
    first = frame(spark, some(1, [1, 2]))
    tables.upsert("t", first, DDL, KEYS, RULES, applied=("batch:1",))
    before = rows_of(tables.read("t", DDL), *KEYS, "a")
    broken = frame(spark, some(2, [2])).withColumn("note", F.raise_error(F.lit("lost")).cast("string"))
    for write in (lambda: tables.upsert("t", broken, DDL, KEYS, RULES, applied=("batch:2",)), lambda: tables.replace("t", broken)):
        with pytest.raises(Exception, match="lost"):
            write()
    assert rows_of(tables.read("t", DDL), *KEYS, "a") == before and tables.applied("t") == {"batch:1"}
    tables.upsert("t", frame(spark, []), DDL, KEYS, RULES, applied=("batch:2",))
    assert rows_of(tables.read("t", DDL), *KEYS, "a") == before and tables.applied("t") == {"batch:1", "batch:2"}
    tables.replace("t", frame(spark, some(3, [5], nulls=False)), applied=("anew",))
    assert set(tables.read("t", DDL).select(F.month("day")).distinct().toPandas().iloc[:, 0]) == {5} and tables.applied("t") == {"anew"}


def test_old_versions_of_parts_go(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), LAYOUT)
    for n in range(3):
        tables.upsert("t", frame(spark, some(n, [n + 1, n + 2])), DDL, KEYS, RULES)
    rows = rows_of(tables.read("t", DDL), *KEYS, "a", "b")
    there = len(tables._part_folders("t"))
    tables.expire("t", 1)
    assert rows_of(tables.read("t", DDL), *KEYS, "a", "b") == rows
    left = tables._part_folders("t")
    assert len(left) < there and len({values for values, _, _ in left}) == len(left)


def test_damage_is_not_an_empty_table(spark, tmp_path):
    import shutil

    tables = Tables(spark, str(tmp_path), LAYOUT)
    assert tables.read("t", DDL).count() == 0 and tables.applied("t") == set()
    tables.upsert("t", frame(spark, some(1, [1])), DDL, KEYS, RULES)
    shutil.move(tmp_path / "t/data", tmp_path / "elsewhere")
    with pytest.raises(RuntimeError, match="its data is gone"):
        tables.read("t", DDL)


def test_sums_maxima_and_the_newest_row_in_any_order(spark):
    ddl = "k string, s bigint, m bigint, at int, v string"
    target = spark.createDataFrame([("a", 1, None, 5, "old"), ("b", None, 3, 5, "old"), ("c", 7, 7, 5, "m")], ddl)
    batch = spark.createDataFrame([("a", 2, 4, 4, "new"), ("b", 2, 2, 6, "new"), ("c", 2**62, 1, 5, "z"), ("d", 1, 1, 1, "d")], ddl)
    added = rows_of(upsert(target, batch, ["k"], {"s": ADD, "m": MOST, "v": BATCH, "at": BATCH}), "k", "s", "m")
    assert added == [("a", 3, 4), ("b", None, 3), ("c", 2**62 + 7, 7), ("d", 1, 1)]
    rules = {name: BATCH for name in ("s", "m", "at", "v")}
    for one, other in ((target, batch), (batch, target)):
        assert rows_of(upsert(one, other, ["k"], rules, ("at",)), "k", "v") == [("a", "old"), ("b", "new"), ("c", "z"), ("d", "d")]
