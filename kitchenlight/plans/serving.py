"""Dashboard queries over the marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kitchenlight.functions import contains_ci, round_to, share_pct
from kitchenlight.operators.quantiles import cross_one_row, exact_quantiles
from kitchenlight.operators.ranking import direction, top_rows, top_rows_per_key
from kitchenlight.plans.marts import POINT_TYPE
from kitchenlight.sources.delimited import write_csv

# Display names of the exported columns.
DISPLAY_NAMES = {
    "facility_name": "Facility",
    "facility_address": "Address",
    "facility_city": "City",
    "facility_zip5": "ZIP",
    "latest_grade": "Grade",
    "latest_score": "Score",
    "cleanliness_index": "Cleanliness Index",
    "inspections_12mo": "Inspections (12mo)",
    "distance_miles": "Distance (mi)",
    "near_me_score": "Near-Me Score",
}
_PROFILE_COLUMNS = (
    "facility_key",
    "facility_name",
    "facility_address",
    "facility_city",
    "facility_state",
    "facility_zip5",
    "owner_name",
    "latest_activity_date",
    "latest_score",
    "latest_grade",
    "cleanliness_index",
    "inspections_12mo",
    "low_data_flag",
)


# ---- overview ----


def kpi_summary(health: DataFrame) -> DataFrame:
    """One row: facilities, median index, share with little data, latest inspection date."""
    rows = F.count(F.lit(1))
    counts = health.agg(
        rows.alias("n_facilities"),
        share_pct(F.count_if("low_data_flag"), rows).alias("pct_low_data"),
        F.max("latest_activity_date").alias("ref_date"),
    )
    median = exact_quantiles(health, "cleanliness_index", {"median_ci": 0.5})
    return cross_one_row(counts, median).select(
        "n_facilities", round_to(F.col("median_ci"), 2).alias("median_ci"), "pct_low_data", "ref_date"
    )


def value_list(health: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values of a column (the city and ZIP pick lists)."""
    return health.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def zip_is_known(zip_geo: DataFrame, zip_code: str) -> DataFrame:
    """One row ``known``: whether the ZIP has a centroid."""
    return zip_geo.filter(F.col("zip") == zip_code).agg((F.count(F.lit(1)) > 0).alias("known"))


def zips_known(health: DataFrame, zip_geo: DataFrame) -> DataFrame:
    """Every ZIP with facilities and whether it has a centroid."""
    centroids = zip_geo.select(F.col("zip").alias("facility_zip5"), F.lit(True).alias("found")).distinct()
    return (
        health.select("facility_zip5")
        .distinct()
        .join(centroids, "facility_zip5", "left")
        .select("facility_zip5", F.coalesce("found", F.lit(False)).alias("known"))
    )


# ---- filters shared by the ranking, search and map queries ----


def _eligible(df: DataFrame, min_inspections: int, include_low_data: bool) -> DataFrame:
    kept = df.filter(F.col("inspections_12mo") >= min_inspections)
    return kept if include_low_data else kept.filter(~F.col("low_data_flag"))


def _matches(text: str) -> Column:
    """Name, address or city contains the text, or the ZIP equals it."""
    needle = text.strip()
    fields = ("facility_name", "facility_address", "facility_city")
    return reduce(Column.__or__, [contains_ci(F.col(name), needle) for name in fields]) | (
        F.col("facility_zip5") == needle
    )


def _order(metric: str, descending: bool) -> list[Column]:
    return [direction(metric, descending), F.col("facility_key").asc()]


def _health_columns(kept: DataFrame, descending: bool, n: int, ranked: bool) -> DataFrame:
    """The first ``n`` rows by index, rounded for display, optionally with their rank in ``#``.

    The rank is numbered over the limited rows only, so its unpartitioned window stays small.
    """
    order = _order("cleanliness_index", descending)
    rank = [F.row_number().over(W.orderBy(*order)).alias("#")] if ranked else []
    return top_rows(kept, order, n).select(
        *rank,
        "facility_name",
        "facility_address",
        "facility_city",
        "facility_zip5",
        "latest_grade",
        "latest_score",
        round_to(F.col("cleanliness_index"), 2).alias("cleanliness_index"),
        "inspections_12mo",
        "facility_key",
    )


def ranked_facilities(
    health: DataFrame,
    mode: str = "best",
    min_inspections: int = 2,
    include_low_data: bool = False,
    n: int = 50,
    ranked: bool = False,
) -> DataFrame:
    """Best or worst facilities by index."""
    kept = _eligible(health, min_inspections, include_low_data).filter(F.col("cleanliness_index").isNotNull())
    return _health_columns(kept, mode == "best", n, ranked)


def search_facilities(
    health: DataFrame,
    text: str,
    city: str = "",
    zip_code: str = "",
    min_inspections: int = 2,
    include_low_data: bool = False,
    n: int = 500,
    ranked: bool = False,
) -> DataFrame:
    """Facilities matching the text, optionally in one city or ZIP, best first."""
    kept = _eligible(health, min_inspections, include_low_data)
    if city:
        kept = kept.filter(F.col("facility_city") == city)
    if zip_code:
        kept = kept.filter(F.col("facility_zip5") == zip_code)
    return _health_columns(kept.filter(_matches(text)), True, n, ranked)


# ---- map ----


def _map_rows(df: DataFrame, metric: str, mode: str, text: str, n: int) -> DataFrame:
    if mode in ("best", "worst"):
        return top_rows(df.filter(F.col(metric).isNotNull()), _order(metric, mode == "best"), n)
    return top_rows(df.filter(_matches(text)), _order(metric, True), n)


def map_by_health(
    health: DataFrame,
    zip_geo: DataFrame,
    mode: str = "best",
    text: str = "",
    min_inspections: int = 2,
    include_low_data: bool = False,
    n: int = 200,
) -> DataFrame:
    """Map points by cleanliness index, placed at the ZIP centroid."""
    centroids = zip_geo.select(F.col("zip").alias("facility_zip5"), "lat", "lon")
    placed = _eligible(health, min_inspections, include_low_data).join(centroids, "facility_zip5")
    return _map_rows(placed, "cleanliness_index", mode, text, n).select(
        "facility_name",
        "facility_city",
        "facility_zip5",
        round_to(F.col("cleanliness_index"), 2).alias("cleanliness_index"),
        "facility_key",
        "lat",
        "lon",
    )


def map_by_near_me(
    near: DataFrame,
    health: DataFrame,
    mode: str = "best",
    text: str = "",
    min_inspections: int = 2,
    include_low_data: bool = False,
    n: int = 200,
) -> DataFrame:
    """Map points by distance-discounted index."""
    visits = health.select("facility_key", "inspections_12mo")
    kept = _eligible(near.join(visits, "facility_key"), min_inspections, include_low_data)
    return _map_rows(kept, "near_me_score", mode, text, n).select(
        "facility_name",
        "facility_city",
        "facility_zip5",
        round_to(F.col("near_me_score"), 2).alias("near_me_score"),
        round_to(F.col("distance_miles"), 1).alias("distance_miles"),
        "facility_key",
        F.col("zip_lat").alias("lat"),
        F.col("zip_lon").alias("lon"),
    )


def color_scale(points: DataFrame, metric: str, mode: str) -> DataFrame:
    """Add ``color``, an RGBA array shaded by the metric's position between the result's extremes.

    A missing metric counts as zero; a result with one value is shaded at the middle.
    """
    points = points.dropna(subset=["lat", "lon"])
    value = F.coalesce(F.col(metric), F.lit(0.0)).cast("double")
    # The points are the limited rows of one map, so the window over all of them is bounded.
    everything = W.partitionBy()
    extremes = {"low_end": F.min(value).over(everything), "high_end": F.max(value).over(everything)}
    span = F.col("high_end") - F.col("low_end")
    level = F.when(span > 0, (value - F.col("low_end")) / span).otherwise(F.lit(0.5))
    rest = F.lit(1.0) - level
    # Start and travel of the red, green and blue channels, and the opacity.
    channels = {
        "BEST": (30 + rest * 60, 160 + level * 95, 30 + rest * 60),
        "WORST": (160 + rest * 95, 30 + level * 100, 30 + level * 60),
        "SEARCH": (F.lit(20), 100 + level * 80, 180 + level * 75),
    }[mode.upper()]
    rgba = F.array(*[channel.cast("int") for channel in channels], F.lit(210))
    return points.withColumns(extremes).withColumn("color", rgba).drop("low_end", "high_end")


def map_center(points: DataFrame, zip_geo: DataFrame, home_zip: str) -> DataFrame:
    """One row ``lat, lon``: the home ZIP's centroid, else the mean of the points that have both coordinates."""
    return map_centers(points, zip_geo, [home_zip]).select("lat", "lon")


def map_centers(points: DataFrame, zip_geo: DataFrame, home_zips: Sequence[str]) -> DataFrame:
    """``map_center`` of several home ZIPs, ``home_zip, lat, lon``; the points are averaged once."""
    mean = points.dropna(subset=["lat", "lon"]).agg(F.avg("lat").alias("mean_lat"), F.avg("lon").alias("mean_lon"))
    wanted = mean.withColumn("home_zip", F.explode(F.array(*[F.lit(code) for code in home_zips])))
    home = (
        zip_geo.filter(F.col("zip").isin(*home_zips))
        .groupBy(F.col("zip").alias("home_zip"))
        .agg(F.min(F.struct("lat", "lon")).alias("home"))
    )
    known = F.col("home").isNotNull()
    return wanted.join(home, "home_zip", "left").select(
        "home_zip",
        F.when(known, F.col("home.lat")).otherwise(F.col("mean_lat")).alias("lat"),
        F.when(known, F.col("home.lon")).otherwise(F.col("mean_lon")).alias("lon"),
    )


# ---- facility details ----


def _only(df: DataFrame, facility: str | None) -> DataFrame:
    """One facility's rows, pushed down to the scan, or all of them."""
    return df if facility is None else df.filter(F.col("facility_key") == facility)


def facility_profile(health: DataFrame, near: DataFrame | None, facility: str | None = None) -> DataFrame:
    """Details with the near-me score and distance where there are any, for one facility or all.

    Without a near-me mart both are NULL.
    """
    if near is None:
        missing = {name: F.lit(None).cast("double") for name in ("near_me_score", "distance_miles")}
        return _only(health, facility).select(*_PROFILE_COLUMNS).withColumns(missing)
    scores = _only(near, facility).select("facility_key", "near_me_score", "distance_miles")
    return _only(health, facility).select(*_PROFILE_COLUMNS).join(scores, "facility_key", "left")


def recent_inspections(inspections: DataFrame, facility: str | None = None, n: int = 5) -> DataFrame:
    """Latest inspections, for one facility or for each."""
    order = [F.col("activity_date").desc_nulls_last(), F.col("serial_number").asc()]
    rows = _only(inspections, facility).select("facility_key", "activity_date", "serial_number", "score", "grade")
    if facility is not None:
        return top_rows(rows, order, n).drop("serial_number")
    return top_rows_per_key(rows, "facility_key", order, n).drop("serial_number")


def top_violations(violations: DataFrame, facility: str | None = None, n: int = 10) -> DataFrame:
    """Violation descriptions with the most points, for one facility or for each."""
    totals = (
        _only(violations, facility)
        .groupBy("facility_key", "violation_description")
        .agg(F.count(F.lit(1)).alias("occurrences"), F.sum(F.col("points").cast(POINT_TYPE)).cast("double").alias("total_points"))
    )
    order = [F.col("total_points").desc_nulls_last(), F.col("violation_description").asc_nulls_last()]
    if facility is not None:
        return top_rows(totals, order, n)
    return top_rows_per_key(totals, "facility_key", order, n)


# ---- export ----


def ranked_export(ranked: DataFrame, n: int = 50) -> DataFrame:
    """First ``n`` rows of a ranked result under their display names, without the key."""
    return ranked.filter(F.col("#") <= n).drop("facility_key").withColumnsRenamed(DISPLAY_NAMES)


def write_ranked_export(ranked: DataFrame, path: str, n: int = 50) -> DataFrame:
    """Write ``ranked_export`` as one CSV file in rank order, and read it back. At most ``n`` rows."""
    shown = ranked_export(ranked, n)
    write_csv(shown, path, order_by=["#"], single_file=True)
    return shown.sparkSession.read.csv(path, header=True, schema=shown.schema, escape='"', mode="FAILFAST")


def display_defaults(df: DataFrame) -> DataFrame:
    """Missing text as ``N/A`` and missing numbers as zero."""
    return df.fillna("N/A").fillna(0)
