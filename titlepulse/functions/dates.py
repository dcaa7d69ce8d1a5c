"""Calendar functions.  None depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_epoch(seconds: Column) -> Column:
    """UTC date of epoch seconds."""
    return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))


def week_start(day: Column) -> Column:
    """Monday of the date's ISO week, as DATE."""
    return F.date_sub(day, F.weekday(day))


def month_start(day: Column) -> Column:
    """First day of the date's month, as DATE."""
    return F.trunc(day, "month")


def quarter_start(day: Column) -> Column:
    """First day of the date's quarter, as DATE."""
    return F.trunc(day, "quarter")


def iso_day(day: Column) -> Column:
    """``yyyy-MM-dd`` text of a date, the form the derived tables keep weeks and months in."""
    return day.cast("string")
