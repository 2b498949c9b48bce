"""Distance-ranked mart around a home ZIP."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.functions import distance_discount, haversine_miles, round_to
from kitchenlight.operators.audits import AuditFailure, count_checks, union_checks
from kitchenlight.operators.ranking import top_rows
from kitchenlight.schemas import column_names

# The greatest index, which the mart's checks enforce.
HIGHEST_INDEX = 100.0
# Rings of 1, 2, 4, ... miles: the last ends beyond half the Earth's circumference, some 12,440 miles.
RINGS = 14


def geo_checks() -> dict[str, Column]:
    return {"coordinates missing": F.count_if(F.col("lat").isNull() | F.col("lon").isNull())}


def geo_audit(zip_geo: DataFrame) -> DataFrame:
    """Centroids without coordinates: ``(table_name, check_name, failures)``."""
    return count_checks(zip_geo, "dim_zip_geo", geo_checks())


def home_point(zip_geo: DataFrame, home_zip: str) -> DataFrame:
    """One row ``lat, lon``: the home ZIP's centroid. Of several rows for it, one is taken whole."""
    point = F.min(F.struct("lat", "lon")).alias("point")
    return zip_geo.filter(F.col("zip") == home_zip.strip()).agg(point).select("point.lat", "point.lon")


def _home_coordinate(zip_geo: DataFrame, home_zip: str, name: str) -> Column:
    """A coordinate of the home centroid as a scalar subquery; an unknown home ZIP fails the job."""
    found = home_point(zip_geo, home_zip).select(name).scalar()
    message = F.lit(f"home ZIP {home_zip!r} has no centroid")
    return F.coalesce(found, F.raise_error(message).cast("double"))


def near_me(health: DataFrame, zip_geo: DataFrame, home_zip: str) -> DataFrame:
    """Facilities with the distance of their ZIP from home and the index discounted by it.

    The distance is worked out per centroid, before the join, so its trigonometry runs once per ZIP.
    The centroid table is not hinted: Spark broadcasts it when its measured size allows.
    """
    home_zip = home_zip.strip()
    centroids = zip_geo.select(
        F.col("zip").alias("facility_zip5"),
        F.col("lat").alias("zip_lat"),
        F.col("lon").alias("zip_lon"),
        haversine_miles(
            _home_coordinate(zip_geo, home_zip, "lat"),
            _home_coordinate(zip_geo, home_zip, "lon"),
            F.col("lat"),
            F.col("lon"),
        ).alias("distance_miles"),
    )
    return (
        health.join(centroids, "facility_zip5")
        .withColumn("home_zip", F.lit(home_zip))
        .withColumn("near_me_score", distance_discount(F.col("cleanliness_index"), F.col("distance_miles")))
        .select(*column_names("mart_near_me"))
    )


def dropped_zips(health: DataFrame, zip_geo: DataFrame, n: int = 10) -> DataFrame:
    """ZIPs of facilities that have no centroid, most facilities first.

    Facilities are counted per ZIP before the anti join. The NULL rule of ``NOT IN`` holds: a NULL ZIP is not
    listed, and with a NULL among the centroids' ZIPs nothing is.
    """
    null_codes = zip_geo.agg(F.count_if(F.col("zip").isNull())).scalar()
    counted = (
        health.filter(F.col("facility_zip5").isNotNull())
        .groupBy("facility_zip5")
        .agg(F.count(F.lit(1)).alias("facility_count"))
    )
    missing = counted.join(zip_geo.select(F.col("zip").alias("facility_zip5")), "facility_zip5", "left_anti")
    missing = missing.filter(null_codes == 0)
    return top_rows(missing, [F.col("facility_count").desc(), F.col("facility_zip5").asc()], n)


def near_me_checks() -> dict[str, Column]:
    """The hard counts of the near-me mart, by check."""
    miles = F.col("distance_miles")
    return {
        "facility_key missing": F.count_if(F.col("facility_key").isNull()),
        "distance_miles missing": F.count_if(miles.isNull()),
        "distance_miles negative": F.count_if(miles < 0),
    }


def near_me_audit(near: DataFrame, health: DataFrame) -> DataFrame:
    """Hard checks on the mart and its row parity with the health mart."""
    return union_checks(count_checks(near, "mart_near_me", near_me_checks()), row_parity(near, health))


def row_parity(near: DataFrame, health: DataFrame) -> DataFrame:
    """Difference in rows between the two marts, as a check row."""
    rows = F.count(F.lit(1))
    both = near.agg(rows.alias("near_rows")).crossJoin(F.broadcast(health.agg(rows.alias("health_rows"))))
    return both.select(
        F.lit("mart_near_me").alias("table_name"),
        F.lit("rows differ from mart_facility_health").alias("check_name"),
        F.abs(F.col("near_rows") - F.col("health_rows")).alias("failures"),
    )


def require_all_placed(near: DataFrame, health: DataFrame, zip_geo: DataFrame) -> None:
    """Fail when the ZIP join dropped facilities, naming the (at most ten) commonest missing ZIPs."""
    if row_parity(near, health).filter(F.col("failures") > 0).isEmpty():
        return
    listed = ", ".join(f"{row.facility_zip5} ({row.facility_count})" for row in dropped_zips(health, zip_geo).collect())
    raise AuditFailure(f"facilities whose ZIP has no centroid: {listed}")


def reach(rated: DataFrame, n: int) -> int | None:
    """Miles from which on no facility can be among the ``n`` best scores, or None where all distances must be read.

    A score is the index, at most 100, over one plus the distance. Rings of doubling width are read outwards, each by a
    range of distances that the scan takes, until the n-th best score so far is above all that the next ring allows.
    Equal scores beyond are not possible then. At most ``RINGS`` rings cover the Earth; n scores come to the driver.
    """
    best: list[float] = []
    miles = F.col("distance_miles")
    for ring in range(RINGS):
        inner, outer = 2**ring - 1, 2 ** (ring + 1) - 1
        found = rated.filter((miles >= float(inner)) & (miles < float(outer))).select("near_me_score")
        scores = [r.near_me_score for r in top_rows(found, [F.col("near_me_score").desc()], n).collect()]
        best = sorted(best + scores, reverse=True)[:n]
        if len(best) == n and best[-1] > HIGHEST_INDEX * (1.0 / (1.0 + outer)):
            return outer
    return None


def near_me_top(near: DataFrame, n: int = 25) -> DataFrame:
    """Best facilities by distance-discounted index, rounded for display.

    Only those within ``reach`` are read; the mart lies in order of the distance. The mart's checks hold the index to
    0 to 100 and the distance to zero or more, on which the reach rests.
    """
    rated = near.filter(F.col("cleanliness_index").isNotNull())
    limit = reach(rated, n)
    close = rated if limit is None else rated.filter(F.col("distance_miles") < float(limit))
    ranked = top_rows(close, [F.col("near_me_score").desc_nulls_last(), F.col("facility_key").asc()], n)
    return ranked.select(
        "facility_name",
        "facility_city",
        "facility_zip5",
        round_to(F.col("distance_miles"), 2).alias("distance_miles"),
        round_to(F.col("cleanliness_index"), 4).alias("cleanliness_index"),
        round_to(F.col("near_me_score"), 4).alias("near_me_score"),
    )


def printable(top: DataFrame) -> DataFrame:
    """Cut the names to the widths of the printed report."""
    # Column widths of the report.
    widths = {"facility_name": 45, "facility_city": 15}
    return top.withColumns(
        {name: F.substring(F.coalesce(name, F.lit("")), 1, width) for name, width in widths.items()}
    )
