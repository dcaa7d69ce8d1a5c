"""Weekly attention per title against its own recent past, and how it splits between cohorts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlepulse.functions import exact_mean_of, exact_sum_of, exact_total_of, iso_day, round_even, safe_ratio, week_start, whole_mean, whole_sum, with_exact_parts
from titlepulse.operators.lookup import lookup_join
from titlepulse.operators.ranking import top_within
from titlepulse.operators.spread import over_cores
from titlepulse.operators.upsert import BATCH
from titlepulse.schemas import (
    ATTENTION_STATE,
    ATTENTION_TRENDS,
    BASELINE_WEEKS,
    COHORT_SPLIT,
    SIGNALS,
    TOP_TITLES,
    Signal,
    columns,
    conform,
)


ATTENTION_KEYS = ["game_id", "week"]
ATTENTION_RULES = {name: BATCH for name in columns(ATTENTION_TRENDS) if name not in ATTENTION_KEYS}
STATE_RULES = {name: BATCH for name in columns(ATTENTION_STATE) if name != "game_id"}


def _any_signal() -> Column:
    return reduce(lambda a, b: a | b, [F.col(s.column).isNotNull() for s in SIGNALS])


def _rates() -> dict[str, Column]:
    """The signals that are averaged, and so may be fractions, by the name of their exact parts."""
    return {f"_parts_{s.column}": F.col(s.column) for s in SIGNALS if s.weekly == "mean"}


def weekly_engagement(engagement: DataFrame, rows: int = 0) -> DataFrame:
    """Signals per title and Monday: counts summed, rates averaged; a week without any signal has no row.

    The days move by title and week, to many small tasks that group them in place: groups take memory by their number,
    and a few packed megabytes hold millions.  There are at most ``rows`` days, if it is given.
    """
    weekly = {
        s.column: (F.try_sum(s.column) if s.weekly == "sum" else exact_mean_of(F.col(f"_parts_{s.column}"))).alias(s.column)
        for s in SIGNALS
    }
    known = engagement.where(F.col("game_id").isNotNull() & F.col("date").isNotNull() & _any_signal())
    days = known.select("game_id", week_start(F.col("date")).alias("week"), *[s.column for s in SIGNALS])
    return with_exact_parts(over_cores(days, "game_id", "week", rows=rows), _rates()).groupBy("game_id", "week").agg(*weekly.values())


def _baseline(signal: Signal, baseline_weeks: int) -> Column:
    """Mean of the signal's last ``baseline_weeks`` earlier observations.

    Weeks in which the signal is absent form a partition of their own, so the frame counts observations and
    not calendar weeks, without turning every row into one row per signal.
    """
    value = F.col(signal.column)
    earlier = (
        Window.partitionBy("game_id", value.isNull()).orderBy("week").rowsBetween(-baseline_weeks, -1)
    )
    # The weekly sums of whole numbers are whole.
    return whole_mean(value, earlier) if signal.weekly == "sum" else exact_mean_of(F.col(f"_parts_{signal.column}"), earlier)


def attention_index(weekly: DataFrame, baseline_weeks: int = BASELINE_WEEKS, carried: DataFrame | None = None, rows: int = 0) -> DataFrame:
    """Per title and week: an index per signal (100 = the title's normal), their mean, and its change.

    All windows lie within a title, which has one row per week of history: the rows move once, to many small tasks, as
    each window holds a sorted copy of its task's rows.  With ``carried`` (rows of
    the state and a ``start``), weeks before the start come from it, as far as later weeks depend on them.  ``rows`` is at
    least the number of weeks, such as that of the days they are made of.
    """
    lead = {"_lead": F.lit(False), "_index": F.lit(None).cast("double")}
    weeks = weekly.withColumns(lead)
    if carried is not None:
        weeks = weeks.unionByName(_lead_rows(carried))
    by_title = with_exact_parts(over_cores(weeks, "game_id", rows=rows), _rates())
    based = by_title.select("*", *[_baseline(s, baseline_weeks).alias(f"_base_{s.index}") for s in SIGNALS])

    def percent(signal: Signal) -> Column:
        value, base = F.col(signal.column), F.col(f"_base_{signal.index}")
        return F.when(value.isNotNull() & (base > 0), value / base * 100).alias(f"_{signal.index}")

    raw = based.select(*weekly.columns, *lead, *[percent(s) for s in SIGNALS])
    indexed = raw.select(
        *weekly.columns, *lead, *[round_even(F.col(f"_{s.index}"), 2).alias(s.index) for s in SIGNALS]
    )
    parted = with_exact_parts(indexed, {f"_parts_{s.index}": F.col(s.index) for s in SIGNALS})
    total = exact_total_of([F.col(f"_parts_{s.index}") for s in SIGNALS])
    present = reduce(lambda a, b: a + b, [F.col(s.index).isNotNull().cast("int") for s in SIGNALS])
    mean = parted.withColumn("_mean", safe_ratio(total, present)).withColumn(
        "attention_index", F.when(F.col("_lead"), F.col("_index")).otherwise(round_even(F.col("_mean"), 2))
    )
    # The last earlier week that has an index, however long ago.
    before = Window.partitionBy("game_id").orderBy("week").rowsBetween(Window.unboundedPreceding, -1)
    previous = F.last("attention_index", ignorenulls=True).over(before)
    return mean.withColumn("_change", F.col("attention_index") - previous).where(~F.col("_lead")).withColumn(
        "attention_wow_delta", round_even(F.col("_change"), 2)
    )


def _lead_rows(carried: DataFrame) -> DataFrame:
    """A row for each carried week before the title's start, with its signals and the last index before the start."""
    before = {s.index: F.filter(f"seen_{s.index}", lambda seen: seen["week"] < F.col("start")) for s in SIGNALS}
    indices = F.filter("indices", lambda seen: seen["week"] < F.col("start"))
    weeks = F.array_distinct(F.concat(*[F.transform(seen, lambda x: x["week"]) for seen in before.values()]))
    rows = carried.select("*", F.get(indices, F.size(indices) - 1)["value"].alias("_index"), F.explode(weeks).alias("_week"))

    def value(signal: Signal) -> Column:
        return F.get(F.filter(f"seen_{signal.index}", lambda seen: seen["week"] == F.col("_week")), F.lit(0))["value"].alias(signal.column)

    return rows.select("game_id", F.col("_week").alias("week"), *[value(s) for s in SIGNALS], F.lit(True).alias("_lead"), "_index")


def carried_state(indexed: DataFrame, carried: DataFrame | None = None, baseline_weeks: int = BASELINE_WEEKS) -> DataFrame:
    """What later weeks need to know of each title of ``indexed``, the rows of :func:`attention_index`.

    These are the last observations of each signal and the last indices: one more than a week needs, so that the last
    week itself can still change.  ``carried`` is the state that these rows were made from.
    """
    kept = {f"seen_{s.index}": (s.column, baseline_weeks + 1) for s in SIGNALS} | {"indices": ("attention_index", 2)}
    observed = [
        F.collect_list(F.when(F.col(column).isNotNull(), F.struct("week", F.col(column).alias("value")))).alias(name)
        for name, (column, _) in kept.items()
    ]
    new = indexed.groupBy("game_id").agg(F.max("week").alias("week"), *observed)
    if carried is None:
        lists = {name: F.col(name) for name in kept}
    else:
        old = carried.select("game_id", *[F.filter(n, lambda seen: seen["week"] < F.col("start")).alias(f"_{n}") for n in kept])
        new = new.join(old, "game_id", "left")
        lists = {name: F.concat(F.coalesce(f"_{name}", F.array()), name) for name in kept}
    newest = [F.slice(F.sort_array(all_, asc=False), 1, kept[name][1]) for name, all_ in lists.items()]
    return conform(new.select("game_id", "week", *[F.sort_array(x).alias(n) for n, x in zip(kept, newest)]), ATTENTION_STATE)


def changed_weeks(days: DataFrame) -> DataFrame:
    """``game_id, week`` of days of titles."""
    return days.select("game_id", week_start(F.col("date")).alias("week")).distinct()


def week_starts(weeks: DataFrame, state: DataFrame) -> DataFrame:
    """``game_id, start, late``: the first changed week of each title, and whether it lies before its last week."""
    first = weeks.groupBy("game_id").agg(F.min("week").alias("start"))
    last = state.select("game_id", F.col("week").alias("_last"))
    return first.join(last, "game_id", "left").select("game_id", "start", F.coalesce(F.col("start") < F.col("_last"), F.lit(False)).alias("late"))


def as_trends(indexed: DataFrame) -> DataFrame:
    return conform(indexed.withColumn("week", iso_day(F.col("week"))), ATTENTION_TRENDS)


def attention_trends(engagement: DataFrame, baseline_weeks: int = BASELINE_WEEKS, rows: int = 0) -> DataFrame:
    """The attention table: see :func:`attention_index`.  ``rows`` is at least the number of days."""
    return as_trends(attention_index(weekly_engagement(engagement, rows), baseline_weeks, rows=rows))


def top_titles(attention: DataFrame, k: int = TOP_TITLES) -> DataFrame:
    """Rows of the ``k`` titles with the highest index of every week; equal ones in order of id."""
    order = [F.col("attention_index").desc_nulls_last(), F.col("game_id").asc()]
    ranked = top_within(attention, ["week"], order, k)
    # Titles without an index rank last, so dropping them here takes no place from another title.
    return ranked.where("attention_index is not null")


def cohort_of(titles: DataFrame) -> DataFrame:
    return titles.select("game_id", F.coalesce("on_steam", F.lit(False)).alias("on_steam"))


def cohort_split(titles: DataFrame, attention: DataFrame, k: int = TOP_TITLES) -> DataFrame:
    """Per week, one row for titles sold on the main store and one for all others.

    Takes the attention table.  Titles absent from the dimension add to neither cohort, but keep the place
    they have among the ``k`` highest.  Both cohorts of a week come from one aggregate over the week.
    """
    known = lookup_join(
        attention.select("week", "game_id", "attention_index", "twitch_avg_viewers", "wiki_pageviews"),
        cohort_of(titles),
        ["game_id"],
        "left",
    )
    on, off = F.col("on_steam"), ~F.col("on_steam")

    viewers = F.coalesce(F.col("twitch_avg_viewers").cast("double"), F.lit(0.0))
    parted = with_exact_parts(known, {"_viewers": viewers})

    def sums(label: str, side: Column) -> list[Column]:
        views = whole_sum(F.when(side, F.coalesce("wiki_pageviews", F.lit(0)))).cast("double")
        return [exact_sum_of(F.when(side, F.col("_viewers"))).alias(f"{label}_twitch_avg_viewers"), views.alias(f"{label}_wiki_pageviews")]

    weeks = parted.groupBy("week").agg(
        F.count_if(on).alias("on_titles"),
        F.count_if(off).alias("off_titles"),
        *sums("on", on),
        *sums("off", off),
    )
    ranked = top_titles(known.select("week", "game_id", "attention_index", "on_steam"), k)
    tops = ranked.groupBy("week").agg(F.count_if(on).alias("on_top"), F.count_if(off).alias("off_top"))

    def row(side: str, label: str) -> Column:
        def share(name: str) -> Column:
            parts = [F.coalesce(F.col(f"{s}_{name}"), F.lit(0.0)) for s in ("on", "off")]
            mine = F.coalesce(F.col(f"{side}_{name}"), F.lit(0.0))
            return safe_ratio(mine, parts[0] + parts[1])

        return F.struct(
            F.lit(label).alias("cohort"),
            F.col(f"{side}_titles").alias("title_count"),
            share("twitch_avg_viewers").alias("_viewers"),
            share("wiki_pageviews").alias("_views"),
            F.coalesce(F.col(f"{side}_top"), F.lit(0)).alias("top20_attention_titles"),
        )

    split = weeks.join(tops, "week", "left").select(
        "week", F.inline(F.array(row("on", "on_steam"), row("off", "off_steam")))
    )
    rounded = split.withColumns(
        {
            "twitch_viewer_share": round_even(F.col("_viewers"), 4),
            "wiki_pageview_share": round_even(F.col("_views"), 4),
        }
    )
    return conform(rounded, COHORT_SPLIT)
