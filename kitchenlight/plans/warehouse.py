"""Facility dimension, inspection and violation facts, and their audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.functions import facility_key
from kitchenlight.operators.audits import count_checks, duplicate_count, orphan_count, union_checks
from kitchenlight.operators.ordinals import HOT_KEY_ROWS, number_by_sort, number_by_window, split_hot_keys
from kitchenlight.operators.quantiles import cross_one_row
from kitchenlight.operators.ranking import top_rows
from kitchenlight.schemas import column_names

_KEY_PARTS = ("facility_name", "facility_address", "facility_zip5", "facility_city")
_DIM_ATTRIBUTES = (
    "facility_name",
    "facility_address",
    "facility_city",
    "facility_state",
    "facility_zip5",
    "facility_id",
    "owner_id",
    "owner_name",
    "service_code",
    "service_description",
    "program_name",
)


def _key() -> Column:
    return facility_key(*[F.col(part) for part in _KEY_PARTS])


def dim_facility(stg_inspections: DataFrame) -> DataFrame:
    """One row per facility key; each attribute is its smallest non-null value.

    A first aggregation collapses equal attribute combinations. It groups on the attributes and keeps only
    fixed-width buffers, so it hashes instead of sorting, and the key is hashed once per combination
    rather than once per inspection. The text minimums then run over the few combinations left.
    """
    combinations = stg_inspections.groupBy(*_DIM_ATTRIBUTES).agg(
        F.min("activity_date").alias("first_date"),
        F.max("activity_date").alias("last_date"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return (
        combinations.withColumn("facility_key", _key())
        .groupBy("facility_key")
        .agg(
            *[F.min(name).alias(name) for name in _DIM_ATTRIBUTES],
            F.min("first_date").alias("first_seen_date"),
            F.max("last_date").alias("last_seen_date"),
            F.sum("row_count").alias("inspection_count"),
        )
    )


def fct_inspection(stg_inspections: DataFrame) -> DataFrame:
    """Staged inspections with the facility key."""
    return stg_inspections.withColumn("facility_key", _key()).select(*column_names("fct_inspection"))


def fct_violation(
    stg_violations: DataFrame, fct_inspections: DataFrame, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Violations with their facility and a key from the serial and the row number inside it.

    Rows are numbered by code, description and points as text, missing ones as blank, then by the
    remaining columns, so only identical rows are interchangeable. Serials are unique among the
    inspections (``core_audit``), so numbering comes before the join, and both use one partitioning by
    serial. A serial holding very many violations is numbered apart, and its few inspections join alone.
    """
    keys = fct_inspections.select("serial_number", "facility_key")
    blank = F.lit("")
    order = [
        ("violation_code", F.coalesce("violation_code", blank)),
        ("violation_description", F.coalesce("violation_description", blank)),
        ("points", F.coalesce(F.col("points").cast("string"), blank)),
    ]

    def finished(numbered: DataFrame, owners: DataFrame) -> DataFrame:
        key = F.sha2(F.concat("serial_number", F.lit("|"), F.col("ordinal").cast("string")), 256)
        return (
            numbered.join(owners, "serial_number")
            .withColumn("violation_key", key)
            .select(*column_names("fct_violation"))
        )

    cold, hot_rows, hot_serials = split_hot_keys(stg_violations, "serial_number", hot_key_rows)
    result = finished(number_by_window(cold, "serial_number", order), keys)
    if hot_rows is None:
        return result
    # As few as the hot serials, since serials are unique here: broadcast, so no task gets all rows of a hot serial.
    owners = F.broadcast(keys.join(F.broadcast(hot_serials), "serial_number", "left_semi"))
    return result.unionByName(finished(number_by_sort(hot_rows, "serial_number", order), owners))


def dim_checks() -> dict[str, Column]:
    """What can be counted while the facility dimension is written."""
    return {"facility_key missing": F.count_if(F.col("facility_key").isNull())}


def key_audit(dim: DataFrame, inspections: DataFrame, stg_violations: DataFrame) -> DataFrame:
    """Duplicate keys and orphans, which need a shuffle of the keys: ``(table_name, check_name, failures)``."""
    orphans = orphan_count(stg_violations, inspections, "serial_number")
    return union_checks(
        count_checks(dim, "dim_facility", {"facility_key duplicated": duplicate_count("facility_key")}),
        count_checks(inspections, "fct_inspection", {"serial_number duplicated": duplicate_count("serial_number")}),
        orphans.select(
            F.lit("fct_violation").alias("table_name"), F.lit("orphan serial_number").alias("check_name"), "failures"
        ),
    )


def core_audit(dim: DataFrame, inspections: DataFrame, stg_violations: DataFrame) -> DataFrame:
    """Null keys, duplicate keys and orphans: ``(table_name, check_name, failures)``."""
    return union_checks(count_checks(dim, "dim_facility", dim_checks()), key_audit(dim, inspections, stg_violations))


def merge_report(stg_inspections: DataFrame, dim: DataFrame | int | None = None) -> DataFrame:
    """One row: distinct facility IDs, distinct keys, IDs merged away and their rate.

    The facility dimension has one row per key, so with ``dim``, or the number of its rows, that is the count of keys.
    """
    ids = stg_inspections.select("facility_id").distinct().agg(F.count("facility_id").alias("distinct_facility_id"))
    # Keys are counted as groups, so rows without a key form one group.
    if isinstance(dim, int):
        counted = ids.withColumn("distinct_facility_key", F.lit(dim).cast("long"))
    else:
        keys = stg_inspections.select(*_KEY_PARTS).distinct().select(_key().alias("facility_key")).distinct() if dim is None else dim
        counted = cross_one_row(ids, keys.agg(F.count(F.lit(1)).alias("distinct_facility_key")))
    merged = F.col("distinct_facility_id") - F.col("distinct_facility_key")
    rate = F.when(F.col("distinct_facility_id") > 0, merged / F.col("distinct_facility_id")).otherwise(F.lit(0.0))
    return counted.select(
        "*", merged.alias("merged_facility_ids"), F.round(rate.cast("double"), 6).alias("merge_rate")
    )


def top_merged(stg_inspections: DataFrame, n: int = 10) -> DataFrame:
    """Facility keys holding several facility IDs, most first."""
    shown = ("facility_name", "facility_address", "facility_zip5", "facility_city")
    merged = (
        stg_inspections.filter(F.col("facility_id").isNotNull())
        .select("facility_id", *shown)
        .distinct()
        .withColumn("facility_key", _key())
        .groupBy("facility_key", "facility_id")
        .agg(*[F.min(name).alias(name) for name in shown])
        .groupBy("facility_key")
        .agg(*[F.min(name).alias(name) for name in shown], F.count(F.lit(1)).alias("facility_id_count"))
        .filter(F.col("facility_id_count") > 1)
    )
    return top_rows(merged, [F.col("facility_id_count").desc(), F.col("facility_key").asc()], n)
