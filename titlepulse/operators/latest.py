"""One winning row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Per key, the row that is largest in ``order``; remaining ties go to the largest row as a whole.

    An aggregate rather than a window: each task sends at most one row per key to the shuffle, however many
    copies of a hot key it holds.
    """
    rest = [name for name in df.columns if name not in keys]
    ordered = F.struct(*[column.alias(f"_{n}") for n, column in enumerate(order)], F.struct(*rest).alias("_row"))
    return df.groupBy(keys).agg(F.max(ordered).alias("_last")).select(*keys, "_last._row.*")
