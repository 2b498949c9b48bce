"""Hashed identity keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kitchenlight.functions.text import clean


def facility_key(name: Column, address: Column, zip_code: Column, city: Column) -> Column:
    """SHA-256 over the normalised name, address, ZIP and city. A NULL part makes the key NULL."""
    bar = F.lit("|")
    return F.sha2(
        F.concat(F.lower(clean(name)), bar, F.lower(clean(address)), bar, zip_code, bar, F.lower(clean(city))),
        256,
    )
