"""Date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_us_date(text: Column) -> Column:
    """``month/day/year`` text to DATE; NULL for anything else, impossible dates included.

    Month and day take one or two digits, the year one to four.
    """
    shaped = text.rlike(r"^\d{1,2}/\d{1,2}/\d{1,4}$")
    return F.when(shaped, F.try_to_date(text, "M/d/y"))
