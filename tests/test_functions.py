import math
import random

import pytest
from pyspark.sql import functions as F

from titlepulse.functions import (
    appid_key, blank_to_null, day_of_epoch, exact_mean, exact_total, month_start, owner_range, quarter_start, release_year,
    round_even, round_half_even_int, safe_ratio, slugify, truthy, week_start,
)


def apply(spark, function, values, ddl):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in frame.orderBy("i").select(function(F.col("v"))).collect()]


def test_slugs(spark):
    names = ["Half-Life 2", "Baldur's Gate 3", "PUBG: BATTLEGROUNDS", "  Rust  ", "???"]
    assert apply(spark, slugify, names, "string") == [
        "half-life-2", "baldur-s-gate-3", "pubg-battlegrounds", "rust", "unknown",
    ]


def test_release_years(spark):
    cases = {
        "16 Nov, 2004": 2004, "Mar 10, 2017": 2017, "2020-05-01": 2020, "Q4 2023": 2023, "2019": 2019,
        "10 mar, 2017": 2017, "": None, "soon": None, "TBA": None, None: None, "1855": 1855,
        "31 Feb, 2011": 2011, "after 1855, in 1999": 1999, " 2020-05-01 ": 2020,
    }
    assert apply(spark, release_year, list(cases), "string") == list(cases.values())


@pytest.mark.parametrize("digits", [2, 4])
def test_round_even_is_exact_on_the_binary_value(spark, digits):
    generator = random.Random(7)
    values = [generator.uniform(-1000, 1000) for _ in range(3000)]
    values += [k / 8 for k in range(-200, 200)] + [k / 200 for k in range(2000)] + [k / 20000 for k in range(2000)]
    values += [2.675, 1.005, 0.125, 0.0, -0.001, 123456789.125]
    got = apply(spark, lambda c: round_even(c, digits), values, "double")
    assert got == [round(v, digits) for v in values]


def test_round_half_even_int(spark):
    assert apply(spark, round_half_even_int, [2.5, 3.5, 2.4999, -0.5], "double") == [2, 4, 2, 0]


def test_owner_ranges(spark):
    texts = ["10,000,000 .. 20,000,000", "x .. 5", "5", "1..2..3", None]
    assert apply(spark, lambda c: F.struct(*owner_range(c)), texts, "string") == [
        (10_000_000, 20_000_000), (None, None), (None, None), (None, None), (None, None),
    ]


def test_calendar(spark):
    days = ["2024-01-01", "2024-01-07", "2023-12-31"]
    as_date = lambda f: lambda c: f(c.cast("date")).cast("string")
    assert apply(spark, as_date(week_start), days, "string") == ["2024-01-01", "2024-01-01", "2023-12-25"]
    assert apply(spark, as_date(month_start), days, "string") == ["2024-01-01", "2024-01-01", "2023-12-01"]
    assert apply(spark, as_date(quarter_start), days, "string") == ["2024-01-01", "2024-01-01", "2023-10-01"]


def test_epoch_days_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = apply(spark, lambda c: day_of_epoch(c).cast("string"), [0, 86399, 86400, -1], "bigint")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["1970-01-01", "1970-01-01", "1970-01-02", "1969-12-31"]


def test_keys_and_blanks(spark):
    assert apply(spark, appid_key, ["570", " 0570 ", "x", "", None], "string") == ["570", "570", None, None, None]
    assert apply(spark, blank_to_null, [" a ", "  ", None], "string") == ["a", None, None]


def test_truthiness(spark):
    texts = ["true", "false", "1", "0", "0.0", '"x"', '""', "[]", "[0]", "{}", '{"a":0}', "null"]
    got = apply(spark, lambda c: truthy(F.parse_json(c)), texts, "string")
    assert got == [True, False, True, False, False, True, False, False, True, False, True, False]
    assert spark.sql("select cast(null as variant) v").select(truthy(F.col("v"))).first()[0] is False


def test_ratio_and_exact_mean(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in frame.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [None, None]
    generator = random.Random(5)
    values = [round(generator.uniform(-50, 5000), 2) for _ in range(999)] + [0.01, 0.3, 1e9, -1e9]
    for order in (values, values[::-1], values[500:] + values[:500]):
        frame = spark.createDataFrame([(v,) for v in order] + [(None,)], "v double").repartition(3)
        assert frame.agg(exact_mean(F.col("v"))).first()[0] == math.fsum(values) / len(values)
    row = spark.createDataFrame([(84.36, 38.88, 65.73, 125.81, None)], "a double, b double, c double, d double, e double")
    assert row.select(exact_total([F.col(c) for c in row.columns])).first()[0] == math.fsum([84.36, 38.88, 65.73, 125.81])
    assert row.where("false").agg(exact_mean(F.col("a"))).first()[0] is None


def test_sums_hold_what_they_promise(spark):
    from titlepulse import functions as fn

    def both(*values):
        frame = spark.createDataFrame([(float(v),) for v in values], "x double")
        return frame.agg(fn.exact_sum(F.col("x")).alias("s"), fn.exact_mean(F.col("x")).alias("m")).first()

    assert both(1e-19, 1e-19)["s"] == 2e-19
    assert both(1e19, 1.0)["s"] == 1e19 + 1
    assert both(9e18, 9e18)["s"] == 1.8e19
    assert both(1e30)["m"] == 1e30
    assert both(0.1, 0.2, 0.3)["s"] == 0.6
    wide = spark.createDataFrame([(9 * 10**18,), (9 * 10**18,)], "n bigint")
    assert wide.agg(fn.whole_mean(F.col("n"))).first()[0] == 9e18
    total = spark.createDataFrame([(1e30, 0.5), (0.1, 0.2)], "a double, b double").select(fn.exact_total([F.col("a"), F.col("b")]))
    assert [r[0] for r in total.collect()] == [1e30, 0.1 + 0.2]


def test_text_after_an_object_makes_it_unreadable(spark):
    from titlepulse.functions import with_json_fields

    texts = ['{"views":5}', ' {"views":5}\n', '{"views":5} trailing', '{"views":5}{"views":6}', '{"views":5},{"views":6}', '[{"views":5}]', "{bad", None, '{"views":5}}']
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    got = with_json_fields(frame, F.col("t"), "views bigint", ["n"])
    assert [r["views"] for r in got.orderBy("n").collect()] == [5, 5] + [None] * 7


def test_white_space_of_all_kinds_is_stripped(spark):
    from titlepulse.functions import blank_to_null

    frame = spark.createDataFrame([("\t",), ("\n a b\u00a0\r\n",), ("",)], "t string")
    assert [r[0] for r in frame.select(blank_to_null(F.col("t"))).collect()] == [None, "a b", None]
