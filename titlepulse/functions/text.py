"""Text functions: identifiers, release dates, owner ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the shapes a release date may have, and the month abbreviations ---------------------------
DAY_MONTH_YEAR = r"^(\d{1,2})\s+([A-Za-z]{3}),\s*(\d{4})$"
MONTH_DAY_YEAR = r"^([A-Za-z]{3})\s+(\d{1,2}),\s*(\d{4})$"
YEAR_MONTH_DAY = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
YEAR_ALONE = r"^(\d{4})$"
YEAR_ANYWHERE = r"(19|20)\d{2}"
UNKNOWN_SLUG = "unknown"
WHITE_ENDS = r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$"
# ---- end of fixed values -------------------------------------------------------------------------------------


def strip(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.regexp_replace(text, WHITE_ENDS, "")


def blank_to_null(text: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def slugify(name: Column) -> Column:
    """URL-style identifier of a name; ``unknown`` when no letter or digit is left."""
    dashed = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.trim(dashed, F.lit("-")), F.lit("")), F.lit(UNKNOWN_SLUG))


def _year_if_date(text: Column, shape: str, year: int, rebuilt: str, pattern: str) -> Column:
    """Year group of a date shape, when the captured parts are a real date."""
    normal = F.regexp_replace(F.initcap(text), shape, rebuilt)
    real = text.rlike(shape) & F.try_to_date(normal, pattern).isNotNull()
    return F.when(real, F.regexp_extract(text, shape, year).try_cast("int"))


def release_year(text: Column) -> Column:
    """Release year of free text: a whole date or year when it is one, else the first 19xx/20xx in it."""
    clean = strip(text)
    anywhere = F.nullif(F.regexp_extract(clean, YEAR_ANYWHERE, 0), F.lit("")).try_cast("int")
    return F.coalesce(
        _year_if_date(clean, DAY_MONTH_YEAR, 3, "$1 $2 $3", "d MMM yyyy"),
        _year_if_date(clean, MONTH_DAY_YEAR, 3, "$2 $1 $3", "d MMM yyyy"),
        _year_if_date(clean, YEAR_MONTH_DAY, 1, "$1-$2-$3", "y-M-d"),
        F.nullif(F.regexp_extract(clean, YEAR_ALONE, 1), F.lit("0000")).try_cast("int"),
        anywhere,
    )


def appid_key(key: Column) -> Column:
    """Canonical text of a whole-number store id; NULL when the key is not one."""
    return strip(key).try_cast("bigint").cast("string")


def owner_range(text: Column) -> tuple[Column, Column]:
    """Bounds of ``"1,000 .. 2,000"``; both NULL unless both ends are whole numbers."""
    ends = F.split(text, r"\.\.", 2)
    low, high = (strip(F.replace(F.get(ends, F.lit(i)), F.lit(","), F.lit(""))).try_cast("bigint") for i in (0, 1))
    both = low.isNotNull() & high.isNotNull()
    return F.when(both, low), F.when(both, high)
