"""Rounding, ratios and sums whose result does not depend on the order rows arrive in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

# A double is summed in three whole parts: its floor, and 60 bits of the fraction in two halves.
_HALF_BITS = 30
_HALF = float(2**_HALF_BITS)
_MASK = 2**_HALF_BITS - 1
# Splits a double into two halves short enough that a product with 10**digits has no rounding error.
_SPLIT = float(2**27 + 1)


def round_even(value: Column, digits: int) -> Column:
    """Round a double to ``digits`` decimals, judging ties on its exact binary value and breaking them to even.

    ``round`` and ``bround`` judge ties on the printed decimal text, so they move 2.675 (stored as
    2.67499...) up.  Here the product ``value * 10**digits`` is only trusted when it is not at a half; at a
    half, the rounding error of the product tells on which side the exact value lies.
    """
    factor = float(10**digits)
    product = value * F.lit(factor)
    wide = value * F.lit(_SPLIT)
    high = wide - (wide - value)
    error = (high * F.lit(factor) - product) + (value - high) * F.lit(factor)
    nearest = F.rint(product)
    # At a half, ``rint`` went to the even side; the exact value may lie on the other one.
    rest = product - nearest
    whole = nearest + F.when((F.abs(rest) == 0.5) & (rest * error > 0), rest * 2).otherwise(F.lit(0.0))
    return whole / F.lit(factor) + F.lit(0.0)


def round_half_even_int(value: Column) -> Column:
    """Round a double to a whole number, ties to even."""
    return F.rint(value).cast("bigint")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL when the denominator is zero or either side is NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def _whole_parts(number: Column) -> tuple[Column, Column, Column]:
    floor = F.floor(number)
    scaled = (number - floor) * F.lit(_HALF)
    upper = F.floor(scaled)
    return floor, upper, F.floor((scaled - upper) * F.lit(_HALF))


def _joined(floor: Column, upper: Column, lower: Column) -> Column:
    upper = upper + F.shiftright(lower, _HALF_BITS)
    floor = floor + F.shiftright(upper, _HALF_BITS)
    fraction = upper.bitwiseAND(F.lit(_MASK)) / F.lit(_HALF)
    return (floor.cast("double") + fraction) + lower.bitwiseAND(F.lit(_MASK)) / F.lit(_HALF * _HALF)


# Below this, the floor of a double fits a bigint with room for the sum of a few.
_WHOLE_LIMIT = float(2**60)


def exact_parts(value: Column) -> Column:
    """A double as ``floor, upper, lower, value``, what :func:`exact_sum_of` adds up.

    The three parts are NULL where they don't hold all bits: the value is huge, not finite, or finer than 2**-60.
    """
    number = value.cast("double")
    floor, upper, lower = _whole_parts(number)
    scaled = (number - floor) * F.lit(_HALF)
    finest = (scaled - upper) * F.lit(_HALF)
    held = (F.abs(number) < _WHOLE_LIMIT) & (finest == lower)
    parts = {"floor": floor, "upper": upper, "lower": lower}
    return F.struct(*[F.when(held, part).alias(name) for name, part in parts.items()], number.alias("value"))


def with_exact_parts(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add a column of parts for each value.  They come out of a generator: Catalyst copies no expression into the sums above."""
    return df.select("*", F.inline(F.array(F.struct(*[exact_parts(value).alias(name) for name, value in values.items()]))))


def exact_sum_of(parts: Column, over: WindowSpec | None = None) -> Column:
    """Aggregate: the sum of doubles given as :func:`exact_parts`, rounded once; NULLs ignored, NULL without values.

    Exact, and the same in any order of rows, where all values are below 2**60, multiples of 2**-60 (as every
    double from 2**-8 up is) and their whole parts add up to a bigint.  In any other case it is the plain sum of
    doubles of the same rows.  With ``over`` it is a window function.
    """
    place = (lambda total: total) if over is None else (lambda total: total.over(over))
    sums = [place(F.try_sum(parts[name])) for name in ("floor", "upper", "lower")]
    all_held = place(F.count(parts["floor"])) == place(F.count(parts["value"]))
    exact = all_held & sums[0].isNotNull() & sums[1].isNotNull() & sums[2].isNotNull()
    return F.when(exact, _joined(*sums)).otherwise(place(F.sum(parts["value"])))


def exact_mean_of(parts: Column, over: WindowSpec | None = None) -> Column:
    """Aggregate: :func:`exact_sum_of` divided by the number of values."""
    count = F.count(parts["value"])
    return safe_ratio(exact_sum_of(parts, over), count if over is None else count.over(over))


def exact_state(parts: Column, name: str) -> list[Column]:
    """Aggregates that hold a sum of parts so that two of them can be added up; a sum of no values is 0, an overflow NULL."""
    sums = [
        F.coalesce(F.try_sum(parts[part]), F.when(F.count(parts[part]) == 0, F.lit(0).cast("bigint"))).alias(f"{name}_{part}")
        for part in ("floor", "upper", "lower")
    ]
    return [
        *sums, F.count(parts["floor"]).alias(f"{name}_held"), F.count(parts["value"]).alias(f"{name}_n"),
        F.coalesce(F.sum(parts["value"]), F.lit(0.0)).alias(f"{name}_plain"),
    ]


def exact_state_mean(name: str) -> Column:
    """The mean of the values in columns of :func:`exact_state`, as :func:`exact_mean_of` has it."""
    sums = [F.col(f"{name}_{part}") for part in ("floor", "upper", "lower")]
    exact = (F.col(f"{name}_held") == F.col(f"{name}_n")) & sums[0].isNotNull() & sums[1].isNotNull() & sums[2].isNotNull()
    return safe_ratio(F.when(exact, _joined(*sums)).otherwise(F.col(f"{name}_plain")), F.col(f"{name}_n"))


def exact_sum(value: Column, over: WindowSpec | None = None) -> Column:
    """:func:`exact_sum_of` a column itself; for many sums, or windows, make the parts first."""
    return exact_sum_of(exact_parts(value), over)


def exact_mean(value: Column, over: WindowSpec | None = None) -> Column:
    """:func:`exact_mean_of` a column itself."""
    return exact_mean_of(exact_parts(value), over)


def whole_sum(value: Column, over: WindowSpec | None = None) -> Column:
    """Aggregate: the exact sum of whole numbers as a decimal, which no number of bigints overflows."""
    total = F.sum(value.cast("decimal(38,0)"))
    return total if over is None else total.over(over)


def whole_mean(value: Column, over: WindowSpec | None = None) -> Column:
    """Aggregate: the mean of whole numbers; one sum instead of the three that doubles need."""
    count = F.count(value)
    return safe_ratio(whole_sum(value, over), count if over is None else count.over(over))


def exact_total_of(parts: list[Column]) -> Column:
    """Sum of several columns of a row, given as their parts; exact under the conditions of :func:`exact_sum_of`, NULLs count as zero."""
    unheld = reduce(lambda a, b: a | b, [p["floor"].isNull() & p["value"].isNotNull() for p in parts])
    added = [reduce(lambda a, b: a + b, [F.coalesce(p[name], F.lit(0)) for p in parts]) for name in ("floor", "upper", "lower")]
    plain = reduce(lambda a, b: a + b, [F.coalesce(p["value"], F.lit(0.0)) for p in parts])
    return F.when(unheld, plain).otherwise(_joined(*added))


def exact_total(values: list[Column]) -> Column:
    """:func:`exact_total_of` columns themselves."""
    return exact_total_of([exact_parts(value) for value in values])
