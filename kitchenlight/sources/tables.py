"""Parquet tables between the stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# Much of the tables is hexadecimal hashes, which the default codec leaves at twice the size they need.
_CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


class EmptyOutput(ValueError):
    """A stage wrote no rows."""


@dataclass(frozen=True)
class Written:
    """A table as read back, its rows, and what else was counted while it was written."""

    table: DataFrame
    rows: int
    counts: dict[str, int]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def write_counted(
    df: DataFrame,
    folder: str,
    name: str,
    counts: Mapping[str, Column] | None = None,
    cluster_by: Sequence[Column | str] = (),
    lookup_by: Sequence[str] = (),
) -> Written:
    """Overwrite a table, counting its rows and ``counts`` in the writing job itself; an empty table is an error.

    ``counts`` are aggregates without DISTINCT. They are gathered in the tasks that write, each of which counts once
    however often it is tried, so nothing is read again to check or report a table.
    With ``cluster_by`` the rows are range-partitioned and sorted on those columns, so later range
    filters skip row groups by their min/max statistics. End the list with a unique column: it splits
    a leading value that holds many rows.
    With ``lookup_by`` each row group gets a Bloom filter of those columns (or, where a column has few values in it, its dictionary serves),
    so a filter on one key skips the row groups without it, whatever the order of the rows.
    """
    names = list(counts or {})
    seen = Observation()
    figures = [counts[c].cast("long").alias(f"m{i}") for i, c in enumerate(names)]
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    filters = {f"parquet.bloom.filter.enabled#{column}": "true" for column in lookup_by}
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *figures)
    counted.write.mode("overwrite").options(**filters).options(**_CODEC).parquet(f"{folder}/{name}")
    found = seen.get
    if not found.get("rows"):
        raise EmptyOutput(f"{name} has no rows")
    table = read_table(df.sparkSession, folder, name)
    return Written(table, found["rows"], {c: found[f"m{i}"] for i, c in enumerate(names)})


def write_table(
    df: DataFrame, folder: str, name: str, cluster_by: Sequence[Column | str] = (), lookup_by: Sequence[str] = ()
) -> DataFrame:
    """``write_counted`` where only the table is wanted."""
    return write_counted(df, folder, name, cluster_by=cluster_by, lookup_by=lookup_by).table
