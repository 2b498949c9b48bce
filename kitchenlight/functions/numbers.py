"""Numeric parsing, rounding and guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the texts accepted as a number. Spark's own cast also takes Java suffixes such as "1d".
_NUMBER_TEXT = r"^\s*([+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan)))\s*$"


def safe_double(text: Column) -> Column:
    """Text to DOUBLE; NULL when it is not a number."""
    return F.when(text.rlike(_NUMBER_TEXT), text.try_cast("double"))


def safe_int(text: Column) -> Column:
    """Text to INT, rounding decimals half away from zero; NULL when not a number or out of range."""
    return F.round(safe_double(text)).try_cast("int")


def round_to(value: Column, digits: int) -> Column:
    """Round the scaled double, as the reference results do (``1.005`` to two digits is ``1.0``)."""
    scale = float(10**digits)
    return F.round(value * scale) / scale


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Limit to ``[low, high]``. NULL is skipped by both functions, so a NULL value gives ``high``."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def per_unit(amount: Column, units: Column) -> Column:
    """Amount per unit as DOUBLE; NULL when there are no units."""
    return F.try_divide(amount.cast("double"), units.cast("double"))


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage with one decimal, in double arithmetic; NULL for an empty whole."""
    return round_to(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 1)
