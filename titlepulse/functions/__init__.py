"""Column functions shared by the plans.  All are compositions of built-ins: nothing leaves the JVM."""

from titlepulse.functions.dates import day_of_epoch, iso_day, month_start, quarter_start, week_start
from titlepulse.functions.numbers import (
    exact_mean,
    exact_mean_of,
    exact_parts,
    exact_state,
    exact_state_mean,
    exact_sum,
    exact_sum_of,
    exact_total,
    exact_total_of,
    whole_mean,
    whole_sum,
    round_even,
    round_half_even_int,
    safe_ratio,
    with_exact_parts,
)
from titlepulse.functions.payload import truthy, variant_text, with_json_fields
from titlepulse.functions.text import appid_key, blank_to_null, owner_range, release_year, slugify, strip

__all__ = [
    "appid_key", "blank_to_null", "day_of_epoch", "exact_mean", "exact_mean_of", "exact_parts", "exact_state", "exact_state_mean", "exact_sum", "exact_sum_of", "exact_total",
    "exact_total_of", "iso_day",
    "month_start", "owner_range", "quarter_start", "release_year", "round_even",
    "round_half_even_int", "safe_ratio", "slugify", "strip", "truthy", "variant_text", "week_start", "whole_mean", "whole_sum",
    "with_exact_parts", "with_json_fields",
]
