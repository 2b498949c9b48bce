"""Manifest of landed files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.operators.quantiles import cross_one_row


class EmptyDataset(ValueError):
    """A landed dataset has no records."""


def landing_manifest(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Records, files and bytes per dataset, from frames freshly read from files.

    Files are listed, not read, for their number and size, so those without records count too.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        listed = df.sparkSession.read.format("binaryFile").load(sorted(df.inputFiles()))
        files = listed.agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("byte_count"))
        return cross_one_row(df.agg(F.count(F.lit(1)).alias("row_count")), files).select(
            F.lit(name).alias("dataset"), "row_count", "file_count", "byte_count"
        )

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in datasets.items()])


def require_records(manifest: DataFrame) -> DataFrame:
    """Return the manifest, or fail naming the datasets without records (one row per dataset is read)."""
    empty = [row.dataset for row in manifest.filter("row_count = 0").select("dataset").collect()]
    if empty:
        raise EmptyDataset(f"no records in {sorted(empty)}")
    return manifest
