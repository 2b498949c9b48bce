"""Schema contracts, the cross-table quality suite and the statistical gates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.operators.audits import count_checks, duplicate_count, orphan_count, union_checks
from kitchenlight.operators.quantiles import cross_one_row, exact_quantiles
from kitchenlight.plans.geo import row_parity
from kitchenlight.plans.warehouse import merge_report
from kitchenlight.schemas import type_name

# Plausible coordinates, and the limits of the statistical gates.
LAT_RANGE, LON_RANGE = (30, 40), (-125, -110)
MAX_PERFECT_SHARE, MAX_MERGE_RATE = 0.05, 0.05


def _actual_columns(tables: Mapping[str, DataFrame], contracts: DataFrame) -> DataFrame:
    """The frames' own column names and types: ``table_name, column_name, actual_type``."""
    spark = contracts.sparkSession
    rows = [
        (table, field.name, type_name(field.dataType)) for table, df in tables.items() for field in df.schema.fields
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, actual_type string")


def _null_counts(tables: Mapping[str, DataFrame], contracts: DataFrame) -> DataFrame | None:
    """NULLs of the not-null columns, one pass per table over those columns only.

    Gives ``table_name, column_name, null_rows``, or ``None`` without such columns. The contracted names are
    read to the driver: there are as many as the schemas have columns.
    """
    wanted: dict[str, list[str]] = {}
    for row in contracts.filter("not_null").select("table_name", "column_name").distinct().collect():
        if row.table_name in tables and row.column_name in tables[row.table_name].columns:
            wanted.setdefault(row.table_name, []).append(row.column_name)
    frames = [
        count_checks(tables[table], table, {name: F.count_if(F.col(name).isNull()) for name in sorted(names)})
        for table, names in sorted(wanted.items())
    ]
    return union_checks(*frames).toDF("table_name", "column_name", "null_rows") if frames else None


def contract_check(contracts: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Check frames against contracted columns (``read_contracts``).

    One row per contracted column: ``table_name, column_name, problems, null_rows``. ``problems`` is empty
    for a sound column. A type fits when its name starts with the contracted one; ``null_rows`` counts the
    NULLs of a not-null column.
    """
    spark = contracts.sparkSession
    known = spark.createDataFrame([(name,) for name in tables], "table_name string").withColumn("exists", F.lit(True))
    null_rows = F.when(F.col("not_null"), F.coalesce("null_rows", F.lit(0))).otherwise(F.lit(0)).cast("long")
    problems = (
        F.when(F.col("exists").isNull(), "missing table")
        .when(F.col("actual_type").isNull(), "missing column")
        .otherwise(
            F.concat_ws(
                "; ",
                F.when(~F.startswith(F.col("actual_type"), F.col("type_prefix")), F.lit("wrong type")),
                F.when(null_rows > 0, F.lit("unexpected nulls")),
            )
        )
    )
    column = ["table_name", "column_name"]
    found = contracts.join(known, "table_name", "left").join(_actual_columns(tables, contracts), column, "left")
    counted = _null_counts(tables, contracts)
    return (
        (found.withColumn("null_rows", F.lit(0)) if counted is None else found.join(counted, column, "left"))
        .select("table_name", "column_name", problems.alias("problems"), null_rows.alias("null_rows"))
    )


def quality_suite(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every quality check as ``(table_name, check_name, failures)``; zero means passed.

    All checks of a table share one scan. Needs the tables named below by key.
    """
    rows = F.count(F.lit(1))
    empty = {"empty": (rows == 0).cast("int")}
    index, miles, score = F.col("cleanliness_index"), F.col("distance_miles"), F.col("near_me_score")
    serial, zip_code = F.col("serial_number"), F.col("facility_zip5")
    checks = {
        "dim_facility": empty | {"facility_key duplicated": duplicate_count("facility_key")},
        "fct_inspection": empty | {"serial_number duplicated": duplicate_count("serial_number")},
        "fct_violation": empty,
        "mart_facility_health": empty
        | {
            "cleanliness_index out of range": F.count_if((index < 0) | (index > 100)),
            "facility_key missing": F.count_if(F.col("facility_key").isNull()),
        },
        "stg_inspections": {
            "serial_number missing": F.count_if(serial.isNull() | (serial == "")),
            "activity_date missing": F.count_if(F.col("activity_date").isNull()),
            "facility_zip5 not five digits": F.count_if(zip_code.isNull() | (F.length(zip_code) != 5)),
        },
        "dim_zip_geo": empty
        | {
            "coordinates out of range": F.count_if(
                ~F.col("lat").between(*LAT_RANGE) | ~F.col("lon").between(*LON_RANGE)
            )
        },
        "mart_near_me": empty
        | {
            "distance_miles negative": F.count_if(miles < 0),
            "near_me_score out of range": F.count_if((score < 0) | (score > 100)),
            "near_me_score above cleanliness_index": F.count_if(score > index),
        },
    }
    frames = [count_checks(tables[name], name, columns) for name, columns in checks.items()]
    orphans = orphan_count(tables["fct_violation"], tables["fct_inspection"], "serial_number").select(
        F.lit("fct_violation").alias("table_name"), F.lit("orphan serial_number").alias("check_name"), "failures"
    )
    return union_checks(*frames, orphans, row_parity(tables["mart_near_me"], tables["mart_facility_health"]))


def stat_gates(health: DataFrame, stg_inspections: DataFrame) -> DataFrame:
    """Plausibility of the scores: rows ``gate, value, threshold, passed``."""
    spread = exact_quantiles(health, "cleanliness_index", {"p50": 0.5, "p90": 0.9})
    perfect = health.agg(
        F.coalesce(
            F.try_divide(F.count_if(F.col("cleanliness_index") == 100).cast("double"), F.count(F.lit(1))),
            F.lit(0.0),
        ).alias("perfect_share")
    )
    row = cross_one_row(spread, perfect, merge_report(stg_inspections).select("merge_rate"))

    def gate(name: str, value: str, threshold, passed):
        return F.struct(
            F.lit(name).alias("gate"),
            F.col(value).alias("value"),
            threshold.alias("threshold"),
            passed.alias("passed"),
        )

    gates = F.array(
        gate("p90 above p50", "p90", F.col("p50"), F.col("p90") > F.col("p50")),
        gate(
            "share of perfect indexes",
            "perfect_share",
            F.lit(MAX_PERFECT_SHARE),
            F.col("perfect_share") <= MAX_PERFECT_SHARE,
        ),
        gate("merge rate", "merge_rate", F.lit(MAX_MERGE_RATE), F.col("merge_rate") < MAX_MERGE_RATE),
    )
    return row.select(F.inline(gates))
