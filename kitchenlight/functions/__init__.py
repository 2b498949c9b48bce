"""Column helpers. Each takes and returns a ``Column`` of Spark built-ins."""

from kitchenlight.functions.dates import parse_us_date
from kitchenlight.functions.geo import distance_discount, haversine_miles
from kitchenlight.functions.keys import facility_key
from kitchenlight.functions.numbers import clamp, per_unit, round_to, safe_double, safe_int, share_pct
from kitchenlight.functions.text import (
    blank_to_null,
    clean,
    clean_upper,
    contains_ci,
    digits_only,
    split_bar_list,
    unquoted,
    zip5,
)

__all__ = [
    "blank_to_null",
    "clamp",
    "clean",
    "clean_upper",
    "contains_ci",
    "digits_only",
    "distance_discount",
    "facility_key",
    "haversine_miles",
    "parse_us_date",
    "per_unit",
    "round_to",
    "safe_double",
    "safe_int",
    "share_pct",
    "split_bar_list",
    "unquoted",
    "zip5",
]
