"""Latest value per group with fixed-width aggregation buffers.

``max_by`` on a struct keeps a variable-width buffer, which rules out hash aggregation and makes Spark
sort every input row. Packing the day and an integer into one BIGINT keeps ``max`` hashable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE_BITS = 32
_INT_MAX = 2**31 - 1


def pack_day_and_int(day: Column, value: Column) -> Column:
    """BIGINT ordered by day, then by *descending* value; NULL when either part is NULL."""
    return F.shiftleft(F.unix_date(day).cast("long"), _VALUE_BITS) + (F.lit(_INT_MAX) - value.cast("long"))


def unpack_int(packed: Column) -> Column:
    """The value inside a packed BIGINT."""
    return (F.lit(_INT_MAX) - packed.bitwiseAND(F.lit(2**_VALUE_BITS - 1))).cast("int")
