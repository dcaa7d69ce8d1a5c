"""Dealing rows to tasks by their number, where files or shuffled bytes say little about the work in them."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS = 200_000
TASKS_PER_CORE = 16


def by_rows(df: DataFrame, *by: str, rows: int = ROWS) -> DataFrame:
    """Rows with equal ``by`` in one task, about ``rows`` in each.  Counts the frame: for tables, not for costly plans."""
    return df.repartition(max(1, -(-df.count() // rows)), *by)


def over_cores(df: DataFrame, *by: str, rows: int = 0) -> DataFrame:
    """Rows with equal ``by`` in one task, and several small tasks for each core; more if ``rows`` are too many for these.

    Adaptive execution joins partitions by their compressed bytes.  Sorted columns of few values shrink so far that
    millions of rows would meet in one task; partitions of a given number stay apart.  ``rows`` is at least the number of
    rows, known from a table the frame is made of: with it, a task's share stays the same however large that table is.
    """
    return df.repartition(max(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS)), *by)
