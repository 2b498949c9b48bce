"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space-separator characters (category Zs). Tabs and line breaks are not in it.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def clean(text: Column) -> Column:
    """Strip Unicode space separators from both ends (``F.trim`` alone strips ASCII spaces only)."""
    return F.btrim(text, F.lit(SPACE_SEPARATORS))


def blank_to_null(text: Column) -> Column:
    """Clean, then turn the empty string into NULL."""
    return F.nullif(clean(text), F.lit(""))


def clean_upper(text: Column) -> Column:
    """Clean, blank to NULL, upper-case."""
    return F.upper(blank_to_null(text))


def zip5(text: Column) -> Column:
    """First run of five digits; ``''`` when there is none, NULL for NULL."""
    return F.regexp_extract(text, "([0-9]{5})", 1)


def digits_only(text: Column) -> Column:
    """Keep the decimal digits (of any script, as the seed-list rule does)."""
    return F.regexp_replace(text, r"[^\p{Nd}]", "")


def split_bar_list(text: Column) -> Column:
    """``a | b||c`` to ``[a, b, c]``: split on bars, clean the items, drop blank ones."""
    items = F.transform(F.split(text, r"\|"), clean)
    return F.filter(items, lambda item: item != "")


def unquoted(text: Column) -> Column:
    """Clean, then strip double quotes from both ends."""
    return F.btrim(clean(text), F.lit('"'))


def contains_ci(text: Column, needle: str) -> Column:
    """Case-insensitive substring match.

    ``%`` and ``_`` inside the user's text stay wildcards. A backslash is an ordinary character,
    so it is doubled for Spark, whose LIKE patterns use it as the escape.
    """
    return text.ilike("%" + needle.replace("\\", "\\\\") + "%")
