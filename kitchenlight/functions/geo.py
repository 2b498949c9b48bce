"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in miles.
EARTH_RADIUS_MILES = 3958.8


def haversine_miles(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance in miles between two points given in degrees."""
    lat_half = F.sin(F.radians((lat_b - lat_a) / 2.0))
    lon_half = F.sin(F.radians((lon_b - lon_a) / 2.0))
    chord = F.pow(lat_half, F.lit(2)) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(
        lon_half, F.lit(2)
    )
    return F.lit(EARTH_RADIUS_MILES) * 2.0 * F.asin(F.sqrt(chord))


def distance_discount(score: Column, miles: Column) -> Column:
    """Score divided by one plus the distance."""
    return score * (F.lit(1.0) / (F.lit(1.0) + miles))
