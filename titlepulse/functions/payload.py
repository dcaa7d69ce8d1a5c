"""Reading raw JSON payloads without trusting their types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# JSON text of the values that count as empty.
_EMPTY = r'^(null|false|""|\[\]|\{\}|-?0+(\.0*)?([eE].*)?)$'


def with_json_fields(df: DataFrame, text: Column, fields: str, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) and one column per field of a JSON object.

    Number fields are strict: a numeric string, a boolean or (for ``bigint``) a fraction gives NULL for that
    field alone.  Broken text, a non-object or an object with anything after it gives NULL in every field.  The fields come out of a generator
    over a one-element array: a filter on them stays above it, so each text is parsed once.
    """
    # In brackets, and parsed as an array, what follows an object shows: broken text, or a second element.
    framed = F.when(F.startswith(F.ltrim(F.translate(text, "\t\r\n", "   ")), F.lit("{")), F.concat(F.lit("["), text, F.lit("]")))
    objects = F.from_json(framed, f"array<struct<{fields}>>", {"allowSingleQuotes": "false"})
    kept = df.columns if keep is None else keep
    parsed = df.select(*kept, F.inline(F.array(F.struct(objects.alias("_objects")))))
    return parsed.select(*kept, F.inline(F.array(F.when(F.size("_objects") == 1, F.get("_objects", F.lit(0))))))


def truthy(value: Column) -> Column:
    """Whether a VARIANT holds something non-empty: not null, false, zero, "", [] or {}; absent is false."""
    return F.coalesce(~F.to_json(value).rlike(_EMPTY), F.lit(False))


def variant_text(value: Column) -> Column:
    """Text of a VARIANT that holds a string; NULL for any other kind."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
