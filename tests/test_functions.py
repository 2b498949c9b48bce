"""Column rules on literal rows."""

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from kitchenlight.functions import (
    blank_to_null,
    clamp,
    clean,
    contains_ci,
    digits_only,
    facility_key,
    haversine_miles,
    parse_us_date,
    round_to,
    safe_double,
    safe_int,
    split_bar_list,
    zip5,
)


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_strips_unicode_spaces_but_not_tabs(spark):
    values = ["  a ", " a ", "　a b ", "\ta\t", "   ", None]
    assert apply(spark, clean, values) == ["a", "a", "a b", "\ta\t", "", None]
    assert apply(spark, blank_to_null, values) == ["a", "a", "a b", "\ta\t", None, None]


def test_zip5(spark):
    assert apply(spark, zip5, ["91754", " 91754-1234 ", "unknown", "1234", "a917541", None]) == [
        "91754",
        "91754",
        "",
        "",
        "91754",
        None,
    ]


def test_digits_and_lists(spark):
    assert apply(spark, digits_only, ["9-17.54x", ""]) == ["91754", ""]
    assert apply(spark, split_bar_list, [" a |b||c ", "", "|"]) == [["a", "b", "c"], [], []]


def test_dates(spark):
    values = ["1/2/2024", "01/02/2024", "01/02/24", "13/1/2024", "2/30/2024", "1/2/2024 10:00", "1/2/20245", "", None]
    expected = [dt.date(2024, 1, 2), dt.date(2024, 1, 2), dt.date(24, 1, 2)] + [None] * 6
    assert apply(spark, parse_us_date, values) == expected


def test_safe_int_rounds_half_away_from_zero(spark):
    values = ["95", "95.5", "94.5", "-0.5", "1e2", "+5", "1d", "abc", "", "3000000000", "nan", None]
    assert apply(spark, safe_int, values) == [95, 96, 95, -1, 100, 5, None, None, None, None, None, None]


def test_safe_double(spark):
    assert apply(spark, safe_double, ["1.5e0", ".5", "1d", "1f", "x", None]) == [1.5, 0.5, None, None, None, None]


def test_round_to_works_on_the_scaled_double(spark):
    assert apply(spark, lambda c: round_to(c, 2), [1.005, 2.675, -1.239], "double") == [1.0, 2.68, -1.24]


def test_clamp_skips_null(spark):
    assert apply(spark, clamp, [-1.0, 50.0, 101.0, None], "double") == [0.0, 50.0, 100.0, 100.0]


def test_facility_key(spark):
    frame = spark.createDataFrame(
        [(" Cafe ", "1 Main St", "91754", "ALHAMBRA"), ("Cafe", None, "91754", "ALHAMBRA")], "n string, a string, z string, c string"
    )
    keys = [r.k for r in frame.select(facility_key(*[F.col(c) for c in "nazc"]).alias("k")).collect()]
    assert keys == [hashlib.sha256(b"cafe|1 main st|91754|alhambra").hexdigest(), None]


@pytest.mark.parametrize(
    ("text", "needle", "expected"),
    [
        ("Blue Lake Diner", "lake", True),
        ("Blue Lake Diner", "l_ke", True),
        ("Blue Lake Diner", "bl%diner", True),
        ("a\\b", "a\\b", True),
        ("ab", "a\\b", False),
        ("Blue Lake", "x", False),
    ],
)
def test_contains_ci(spark, text, needle, expected):
    assert apply(spark, lambda c: contains_ci(c, needle), [text]) == [expected]


def test_haversine(spark):
    row = spark.range(1).select(
        haversine_miles(F.lit(34.0), F.lit(-118.0), F.lit(34.0), F.lit(-118.0)).alias("same"),
        haversine_miles(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
    ).first()
    assert row.same == 0.0
    assert math.isclose(row.half, math.pi * 3958.8)
