"""Scored marts: facility health, ZIP health, repeat offenders, index statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.functions import clamp, per_unit, round_to, share_pct
from kitchenlight.operators.audits import count_checks
from kitchenlight.operators.latest import pack_day_and_int, unpack_int
from kitchenlight.operators.quantiles import exact_quantiles
from kitchenlight.schemas import column_names

# Fixed values of the scoring rule: window lengths and age limits in days, weights in tenths.
WINDOW_DAYS = 365
INFO_WINDOW_DAYS = 730
RECENCY_WEIGHT_TENTHS = ((90, 10), (180, 8), (365, 6))
BAD_SCORE_BELOW = 90
VIOLATION_PENALTY, POINT_PENALTY, BAD_EVENT_PENALTY = 12.0, 8.0, 15
INDEX_SHARES = (0.65, 0.25, 0.10)
EXCELLENT_FROM, GOOD_FROM = 90, 70
LOW_DATA_BELOW = 2
# Points are summed exactly, to six decimals.
POINT_TYPE = "decimal(18,6)"
INDEX_TYPE = "decimal(20,10)"


def info_window_start(inspections: DataFrame) -> Column:
    """First day of the long window, as a scalar subquery.

    The subtraction sits inside the subquery: a comparison with the bare subquery is pushed to the Parquet
    scan, one with an expression around it is not. All other dates are counted from this one, since
    different subqueries over one table are merged into a struct and would lose the push-down too.
    """
    return inspections.agg(F.date_sub(F.max("activity_date"), INFO_WINDOW_DAYS)).scalar()


def _recent(inspections: DataFrame, start: Column) -> DataFrame:
    """Keyed inspections of the long window with ``age``, their days before the latest inspection."""
    age = F.datediff(F.date_add(start, INFO_WINDOW_DAYS), F.col("activity_date"))
    kept = inspections.filter(F.col("facility_key").isNotNull() & (F.col("activity_date") >= start))
    return kept.withColumn("age", age)


def _weight_tenths(age: Column) -> Column:
    weight = F.lit(None).cast("int")
    for days, tenths in reversed(RECENCY_WEIGHT_TENTHS):
        weight = F.when(age <= days, tenths).otherwise(weight)
    return weight


def inspection_metrics(inspections: DataFrame, start: Column) -> DataFrame:
    """Per-facility counts, weighted score, bad events and latest results.

    One scan covers both windows. The first aggregation also groups on the ZIP and the grade, which
    leaves only fixed-width buffers: it hashes, combines before the shuffle, and one facility holding much
    of the table shrinks to a handful of rows per task. On one day with several results the lowest
    score and the last grade in the alphabet are shown.
    """
    score, weight = F.col("score"), _weight_tenths(F.col("age"))
    in_window, day = F.col("age") <= WINDOW_DAYS, F.col("activity_date")
    by_grade = (
        _recent(inspections, start)
        .groupBy("facility_key", "facility_zip5", "grade")
        .agg(
            F.count_if(in_window).alias("n12"),
            F.count(F.lit(1)).alias("n24"),
            # Outside the window there is no weight.
            F.sum(score.cast("long") * weight).alias("score_tenths"),
            F.sum(weight.cast("long")).alias("weight_tenths"),
            F.count_if(in_window & (score < BAD_SCORE_BELOW)).alias("bad"),
            F.max(F.when(in_window, day)).alias("last_date"),
            F.max(F.when(in_window, pack_day_and_int(day, score))).alias("last_score"),
        )
    )
    graded = F.when(F.col("grade").isNotNull() & F.col("last_date").isNotNull(), F.struct("last_date", "grade"))
    return (
        by_grade.groupBy("facility_key")
        .agg(
            F.sum("n12").alias("inspections_12mo"),
            F.sum("n24").alias("inspections_24mo"),
            F.try_divide(F.sum("score_tenths") / F.lit(10.0), F.sum("weight_tenths") / F.lit(10.0)).alias(
                "score_trend"
            ),
            F.sum("bad").alias("bad_events"),
            F.max("last_date").alias("latest_activity_date"),
            unpack_int(F.max("last_score")).alias("latest_score"),
            F.max(graded)["grade"].alias("latest_grade"),
            F.min(F.when(F.col("n12") > 0, F.col("facility_zip5"))).alias("facility_zip5"),
        )
        .filter(F.col("inspections_12mo") > 0)
    )


def violation_metrics(violations: DataFrame, inspections: DataFrame, start: Column) -> DataFrame:
    """Violation count and points per facility, over the inspections inside the window.

    Violations are counted per serial before the join, so a serial holding much of the table meets it as one row
    per task. Points are summed as decimals: the order of the rows cannot change the result.
    """
    serials = _recent(inspections, start).filter(F.col("age") <= WINDOW_DAYS).select("serial_number")
    return (
        violations.groupBy("serial_number", "facility_key")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("points").cast(POINT_TYPE)).alias("points"))
        .join(serials, "serial_number", "left_semi")
        .groupBy("facility_key")
        .agg(F.sum("rows").alias("violations"), F.coalesce(F.sum("points").cast("double"), F.lit(0.0)).alias("points"))
    )


def facility_health(inspections: DataFrame, violations: DataFrame, dim: DataFrame) -> DataFrame:
    """Every facility inspected in the trailing twelve months, with its 0-100 cleanliness index."""
    start = info_window_start(inspections)
    trend_share, violation_share, event_share = (F.lit(share) for share in INDEX_SHARES)
    count = F.coalesce(F.col("violations"), F.lit(0)).cast("double")
    points = F.coalesce(F.col("points"), F.lit(0.0))
    visits = F.col("inspections_12mo")
    scored = (
        inspection_metrics(inspections, start)
        .join(violation_metrics(violations, inspections, start), "facility_key", "left")
        .withColumn("violation_count", count)
        .withColumn("total_points", points)
        .withColumn("violations_per_inspection", per_unit(F.col("violation_count"), visits))
        .withColumn("points_per_inspection", per_unit(F.col("total_points"), visits))
        .withColumn(
            "violation_score",
            clamp(
                100.0
                - F.col("violations_per_inspection") * VIOLATION_PENALTY
                - F.col("points_per_inspection") * POINT_PENALTY
            ),
        )
        .withColumn("event_points", clamp((100 - F.col("bad_events") * BAD_EVENT_PENALTY).cast("double")))
        .withColumn("event_score", F.col("event_points").cast("decimal(38,1)"))
        .withColumn("bad_event_count", F.col("bad_events").cast("double"))
        .withColumn(
            "cleanliness_index",
            # A facility without any score has no trend; the clamp then gives it the top index.
            clamp(
                trend_share * F.col("score_trend")
                + violation_share * F.col("violation_score")
                + event_share * F.col("event_points")
            ),
        )
        .withColumn("low_data_flag", visits < LOW_DATA_BELOW)
    )
    named = dim.select(
        "facility_key",
        "facility_name",
        "facility_address",
        "facility_city",
        "facility_state",
        "facility_id",
        "owner_name",
    )
    return scored.join(named, "facility_key").select(*column_names("mart_facility_health"))


def _band_counts() -> dict[str, Column]:
    index = F.col("cleanliness_index")
    return {
        "excellent": F.count_if(index >= EXCELLENT_FROM),
        "good": F.count_if((index >= GOOD_FROM) & (index < EXCELLENT_FROM)),
        "poor": F.count_if(index < GOOD_FROM),
    }


def zip_health(health: DataFrame) -> DataFrame:
    """Index summary, latest-grade shares and bands per ZIP."""
    index, grade, rows = F.col("cleanliness_index"), F.col("latest_grade"), F.count(F.lit(1))
    return health.groupBy("facility_zip5").agg(
        rows.alias("facility_count"),
        # An exact sum: the order of the rows must not decide a rounding.
        round_to(F.try_divide(F.sum(index.cast(INDEX_TYPE)).cast("double"), F.count(index)), 2).alias("avg_cleanliness_index"),
        round_to(F.min(index), 2).alias("min_cleanliness_index"),
        round_to(F.max(index), 2).alias("max_cleanliness_index"),
        *[
            share_pct(F.count_if(condition), rows).alias(name)
            for name, condition in {
                "grade_a_pct": grade == "A",
                "grade_b_pct": grade == "B",
                "grade_c_pct": grade == "C",
                "grade_null_pct": grade.isNull(),
            }.items()
        ],
        *[column.alias(f"{name}_count") for name, column in _band_counts().items()],
    )


def zip_health_order() -> list[Column]:
    return [F.col("avg_cleanliness_index").desc_nulls_last(), F.col("facility_zip5").asc_nulls_last()]


def repeat_offenders(health: DataFrame) -> DataFrame:
    """Facilities with two or more bad events or a poor index."""
    return health.filter((F.col("bad_event_count") >= 2) | (F.col("cleanliness_index") < GOOD_FROM))


def repeat_offenders_order() -> list[Column]:
    return [F.col("cleanliness_index").asc_nulls_last(), F.col("facility_key").asc_nulls_last()]


def index_stats(health: DataFrame) -> DataFrame:
    """One row: minimum, median, 90th percentile and maximum of the index, two decimals."""
    quantiles = exact_quantiles(
        health, "cleanliness_index", {"ci_min": 0.0, "ci_p50": 0.5, "ci_p90": 0.9, "ci_max": 1.0}
    )
    return quantiles.select(*[round_to(F.col(name), 2).alias(name) for name in quantiles.columns])


def band_checks() -> dict[str, Column]:
    """Facilities per index band and with little data, as aggregates."""
    return _band_counts() | {"low_data": F.count_if("low_data_flag")}


def index_bands(health: DataFrame) -> DataFrame:
    """One row: facilities per index band and with little data."""
    return health.agg(*[column.alias(name) for name, column in band_checks().items()])


def mart_checks() -> dict[str, Column]:
    """The hard counts of the facility mart, by check."""
    index = F.col("cleanliness_index")
    return {
        "empty": (F.count(F.lit(1)) == 0).cast("int"),
        "facility_key missing": F.count_if(F.col("facility_key").isNull()),
        "cleanliness_index missing or out of range": F.count_if(index.isNull() | ~index.between(0, 100)),
    }


def mart_audit(health: DataFrame) -> DataFrame:
    """Hard checks on the facility mart: ``(table_name, check_name, failures)``."""
    return count_checks(health, "mart_facility_health", mart_checks())
