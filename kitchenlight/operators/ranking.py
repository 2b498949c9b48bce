"""Top-k: over a whole table and per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def direction(value: Column | str, descending: bool) -> Column:
    """Sort order with NULLs last, either way round."""
    column = F.col(value) if isinstance(value, str) else value
    return column.desc_nulls_last() if descending else column.asc_nulls_last()


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order that ends in a unique column (one bounded heap per task)."""
    return df.orderBy(*order).limit(n)


def top_rows_per_key(df: DataFrame, key: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key.

    The rank limit is also applied before the shuffle, so each task sends at most ``n`` rows of a key
    and a key holding a third of the table stays small.
    """
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("rank_in_key", rank).filter(F.col("rank_in_key") <= n)
