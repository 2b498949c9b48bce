"""JSON run metadata and JSON contracts."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kitchenlight.schemas import contract_columns, contract_tables

CONTRACT_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField(
            "columns",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("type", T.StringType()),
                        T.StructField("not_null", T.BooleanType()),
                    ]
                )
            ),
        ),
    ]
)


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """One row per contracted column: ``table_name, column_name, type_prefix, not_null``. Bad JSON fails."""
    raw = spark.read.schema(CONTRACT_SCHEMA).json(path, multiLine=True, mode="FAILFAST")
    return raw.select("table", F.explode("columns").alias("column")).select(
        F.col("table").alias("table_name"),
        F.col("column.name").alias("column_name"),
        F.upper("column.type").alias("type_prefix"),
        F.coalesce("column.not_null", F.lit(False)).alias("not_null"),
    )


def write_contracts(spark: SparkSession, path: str, tables: Sequence[str] | None = None) -> None:
    """Write this library's own contracts as one JSON array, an object per table."""
    objects = [
        {"table": name, "path": name, "columns": [asdict(column) for column in contract_columns(name)]}
        for name in tables or contract_tables()
    ]
    text = spark.createDataFrame([(json.dumps(objects),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)


def write_run_metadata(metrics: DataFrame, path: str) -> None:
    """Write a one-row metrics frame as JSON, nulls kept. ``generated_at_utc`` is added when absent."""
    if "generated_at_utc" not in metrics.columns:
        now = F.date_format(F.to_utc_timestamp(F.now(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
        metrics = metrics.withColumn("generated_at_utc", now)
    metrics.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)


def read_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Run metadata with ``last_updated`` added: the run date such as ``Aug 01, 2001``.

    A time stamp that does not parse shows its first ten characters; a missing or blank one shows ``N/A``.
    """
    raw = spark.read.json(path, multiLine=True)
    if "generated_at_utc" not in raw.columns:
        return raw.withColumn("last_updated", F.lit("N/A"))
    stamp = F.col("generated_at_utc")
    # The run date is the one written in the stamp, whatever the session's time zone.
    day = F.when(F.try_to_timestamp(stamp).isNotNull(), F.substring(stamp, 1, 10))
    shown = F.coalesce(F.date_format(F.try_to_date(day), "MMM dd, yyyy"), F.substring(stamp, 1, 10), F.lit("N/A"))
    return raw.withColumn("last_updated", F.when(stamp == "", "N/A").otherwise(shown))
