"""Joining a large table with a lookup table that is unique on the join key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame is proven to be within the bounds: one count and one sum, a row from each task."""
    width = F.lit(0)
    for field in df.schema:
        plain = isinstance(field.dataType, (T.NumericType, T.DateType, T.TimestampType, T.BooleanType))
        text = F.col(field.name) if isinstance(field.dataType, T.StringType) else F.to_json(F.struct(field.name))
        width = width + (F.lit(8) if plain else F.coalesce(F.octet_length(text), F.lit(0)) + 8)
    found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("w")).first()
    return found["n"] <= max_rows and found["w"] <= max_bytes


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join facts to a lookup table, ``inner`` or ``left``.

    A lookup table of checked size is broadcast, so the facts do not move.  A larger one is joined by shuffle, where
    adaptive execution splits the part of the facts that one key has made large; no lookup row is copied for keys
    that are not.  The hint keeps Spark from sending it to all tasks nevertheless: it guesses a frame's size from the files
    at its start, and takes millions of rows out of a few packed megabytes, or the facts themselves, for small.  The lookup's plan runs twice, for the check and for the join: stage one that is costly to derive.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup_join cannot do a {how} join")
    return facts.join(F.broadcast(lookup) if fits_broadcast(lookup, max_rows) else lookup.hint("merge"), on, how)
