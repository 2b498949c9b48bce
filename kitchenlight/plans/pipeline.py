"""The batch pipeline: each stage reads the previous stage's tables, checks its own and writes them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kitchenlight.operators.audits import require_clean, require_none
from kitchenlight.operators.quantiles import cross_one_row
from kitchenlight.plans import area, centroids, geo, marts, quality, search, staging, warehouse
from kitchenlight.schemas import contract_tables
from kitchenlight.session import cut_lineage
from kitchenlight.sources.delimited import (
    read_centroids,
    read_broken_extract,
    read_extract,
    read_gazetteer,
    read_overrides,
    read_postal_file,
    read_seed,
    write_csv,
)
from kitchenlight.sources.manifest import landing_manifest, require_records
from kitchenlight.sources.metadata import read_contracts, write_run_metadata
from kitchenlight.sources.tables import Written, read_table, write_counted, write_table

#: Columns that single facilities are looked up by.
LOOKUP = ("facility_key",)


@dataclass(frozen=True)
class Inputs:
    """Paths of the landed files."""

    inspections: str
    violations: str
    seed: str
    centroids: str
    multi_line: bool = False  # whether quoted values of the extracts may hold line breaks


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _known(spark: SparkSession, name: str, figures: Mapping[str, int]) -> DataFrame:
    """One row with figures that are known already as one struct column."""
    fields = [F.lit(value).cast("long").alias(field) for field, value in figures.items()]
    return spark.range(1).select(F.struct(*fields).alias(name))


def _rows_of(tables: Mapping[str, DataFrame], known: Mapping[str, int] | None) -> dict[str, int]:
    """Rows per table: as counted when it was written, else, for a stage that runs alone, from the files' footers."""
    return {f"{name}_rows": known[name] if known and name in known else df.count() for name, df in tables.items()}


def _pack(name: str, *frames: DataFrame) -> DataFrame:
    """One-row frames as one struct column."""
    row = cross_one_row(*frames)
    return row.select(F.struct(*row.columns).alias(name))


def run_area(spark: SparkSession, inputs: Inputs, out: str) -> dict[str, int]:
    """Landed CSV files to the raw rows of the area. Like the next stages, it returns the rows of the tables it wrote."""
    read = read_broken_extract if inputs.multi_line else read_extract
    raw_inspections = read(spark, inputs.inspections, (area.SERIAL, "FACILITY ZIP"))
    raw_violations = read(spark, inputs.violations, (area.SERIAL,))
    # A few rows, kept: the check and the metadata below share one pass over the landed files.
    manifest = require_records(cut_lineage(landing_manifest({"inspections": raw_inspections, "violations": raw_violations})))
    seed = read_seed(spark, inputs.seed)
    kept = write_counted(area.area_inspections(raw_inspections, seed), out, "area_inspections")
    kept_violations = write_counted(area.area_violations(raw_violations, kept.table), out, "area_violations")
    coverage = area.zip_coverage(kept.table, kept_violations.table)
    # One row per ZIP: at most 100,000 rows, so one sorted file is fine.
    write_csv(coverage, f"{out}/zip_coverage", order_by=["zip"], single_file=True)
    outputs = _known(spark, "outputs", {"inspection_rows": kept.rows, "violation_rows": kept_violations.rows})
    landed = manifest.agg(F.sort_array(F.collect_list(F.struct(*manifest.columns))).alias("inputs"))
    write_run_metadata(cross_one_row(_count(seed, "seed_zip_count"), landed, outputs), f"{out}/area_meta")
    return {"area_inspections": kept.rows, "area_violations": kept_violations.rows}


def write_staging(raw_inspections: DataFrame, raw_violations: DataFrame, out: str) -> tuple[Written, Written]:
    """Both staging tables, their checks counted as they are written."""
    return (
        write_counted(staging.stage_inspections(raw_inspections), out, "stg_inspections", staging.inspection_checks()),
        write_counted(staging.stage_violations(raw_violations), out, "stg_violations", staging.violation_checks()),
    )


def run_staging(spark: SparkSession, out: str, known: Mapping[str, int] | None = None) -> dict[str, int]:
    """Area rows to typed staging tables; ``known`` has the rows of the tables read, where they are known."""
    raw = {name: read_table(spark, out, name) for name in ("area_inspections", "area_violations")}
    inspections, violations = write_staging(raw["area_inspections"], raw["area_violations"], out)
    require_none("stg_inspections", staging.hard_counts(inspections.counts))
    require_none("stg_violations", staging.hard_counts(violations.counts))
    write_run_metadata(staging_report(spark, _rows_of(raw, known), inspections, violations), f"{out}/stg_meta")
    return {"stg_inspections": inspections.rows, "stg_violations": violations.rows}


def staging_report(spark: SparkSession, inputs: Mapping[str, int], inspections: Written, violations: Written) -> DataFrame:
    """The staging stage's metadata: rows in and out, NULLs per column, warnings, and every check. No table is read for it."""
    tables = {"stg_inspections": inspections, "stg_violations": violations}
    wanted = {
        "stg_inspections": ("serial_number", "activity_date", "score", "grade"),
        "stg_violations": ("serial_number", "violation_code", "points"),
    }

    def missing(table: str) -> DataFrame:
        return _known(spark, table, {c: tables[table].counts[f"{c} missing"] for c in wanted[table]})

    nulls = _pack("null_counts", *map(missing, tables))
    warnings = _known(spark, "warnings", {"scores_outside_0_100": inspections.counts["score out of range"]})
    outputs = _known(spark, "outputs", {f"{name}_rows": written.rows for name, written in tables.items()})
    listed = sorted((name, check, count) for name, written in tables.items() for check, count in written.counts.items())
    entries = [
        F.struct(F.lit(name).alias("table_name"), F.lit(check).alias("check_name"), F.lit(count).cast("long").alias("failures"))
        for name, check, count in listed
    ]
    checks = spark.range(1).select(F.array(*entries).alias("checks"))
    return cross_one_row(_known(spark, "inputs", inputs), outputs, nulls, warnings, checks)


def run_warehouse(
    spark: SparkSession, out: str, hot_key_rows: int = warehouse.HOT_KEY_ROWS, known: Mapping[str, int] | None = None
) -> dict[str, int]:
    """Staging tables to the star schema."""
    staged = {name: read_table(spark, out, name) for name in ("stg_inspections", "stg_violations")}
    stg_inspections, stg_violations = staged.values()
    dim = write_counted(warehouse.dim_facility(stg_inspections), out, "dim_facility", warehouse.dim_checks())
    require_none("dim_facility", dim.counts)
    # Clustered by date: the scoring window then reads the row groups of its own dates only.
    clustering: list[Column | str] = ["activity_date", "serial_number"]
    inspections = write_counted(warehouse.fct_inspection(stg_inspections), out, "fct_inspection", cluster_by=clustering, lookup_by=LOOKUP)
    require_clean(warehouse.key_audit(dim.table, inspections.table, stg_violations))
    bound = warehouse.fct_violation(stg_violations, inspections.table, hot_key_rows)
    violations = write_counted(bound, out, "fct_violation", lookup_by=LOOKUP)
    rows = {"dim_facility": dim.rows, "fct_inspection": inspections.rows, "fct_violation": violations.rows}
    top = warehouse.top_merged(stg_inspections)
    top_list = top.agg(
        F.sort_array(
            F.collect_list(
                F.struct((-F.col("facility_id_count")).alias("order"), F.col("facility_key"), F.struct(*top.columns).alias("row"))
            )
        )["row"].alias("top_merged_facilities")
    )
    report = _pack("facility_merge_report", warehouse.merge_report(stg_inspections, dim.rows), top_list)
    inputs = _known(spark, "inputs", _rows_of(staged, known))
    outputs = _known(spark, "outputs", {f"{name}_rows": n for name, n in rows.items()})
    write_run_metadata(cross_one_row(inputs, outputs, report), f"{out}/core_meta")
    return rows


def run_marts(spark: SparkSession, out: str, known: Mapping[str, int] | None = None) -> dict[str, int]:
    """Star schema to the scored marts."""
    core = {name: read_table(spark, out, name) for name in ("dim_facility", "fct_inspection", "fct_violation")}
    scored = marts.facility_health(core["fct_inspection"], core["fct_violation"], core["dim_facility"])
    # The names these figures have in the metadata, in the order of the bands.
    band_names = ("excellent_ge90", "good_70_89", "poor_lt70", "low_data_flag")
    health = write_counted(scored, out, "mart_facility_health", marts.mart_checks() | marts.band_checks(), LOOKUP, LOOKUP)
    require_none("mart_facility_health", {name: health.counts[name] for name in marts.mart_checks()})
    by_zip = write_counted(marts.zip_health(health.table).orderBy(*marts.zip_health_order()), out, "mart_zip_health")
    repeat = write_counted(
        marts.repeat_offenders(health.table).orderBy(*marts.repeat_offenders_order()), out, "mart_repeat_offenders"
    )
    rows = {"mart_facility_health": health.rows, "mart_zip_health": by_zip.rows, "mart_repeat_offenders": repeat.rows}
    outputs = _known(spark, "outputs", {f"{name}_rows": n for name, n in rows.items()})
    inputs = _known(spark, "inputs", _rows_of(core, known))
    # The names these figures have in the metadata.
    stats = _pack("cleanliness_index_stats", marts.index_stats(health.table).toDF("min", "p50", "p90", "max"))
    figures = dict(zip(band_names, (health.counts[name] for name in marts.band_checks())))
    bands = _known(spark, "facility_distribution", figures)
    write_run_metadata(cross_one_row(inputs, outputs, stats, bands), f"{out}/marts_meta")
    return rows


def run_geo(
    spark: SparkSession, out: str, zip_geo: DataFrame, home_zip: str, known: Mapping[str, int] | None = None
) -> dict[str, int]:
    """Health mart and centroids to the distance-ranked mart."""
    centroids = write_counted(zip_geo, out, "dim_zip_geo", geo.geo_checks())
    require_none("dim_zip_geo", centroids.counts)
    health = read_table(spark, out, "mart_facility_health")
    scored = geo.near_me(health, centroids.table, home_zip)
    order = ["distance_miles", "facility_key"]
    near = write_counted(scored, out, "mart_near_me", geo.near_me_checks(), cluster_by=order, lookup_by=LOOKUP)
    if near.rows != _rows_of({"mart_facility_health": health}, known)["mart_facility_health_rows"]:
        geo.require_all_placed(near.table, health, centroids.table)
    require_none("mart_near_me", near.counts)
    home = geo.home_point(centroids.table, home_zip).toDF("home_lat", "home_lon")
    rows = {"dim_zip_geo": centroids.rows, "mart_near_me": near.rows}
    counts = [F.lit(n).cast("long").alias(f"{name}_rows") for name, n in rows.items()]
    row = home.select("*", *counts, F.lit(home_zip.strip()).alias("home_zip"))
    write_run_metadata(row, f"{out}/geo_meta")
    return rows


def run_search(spark: SparkSession, out: str, blocks: int = search.BLOCKS) -> search.SearchIndex:
    """Health mart to the tables that text searches look up."""
    return search.write_index(read_table(spark, out, "mart_facility_health"), out, blocks)


def run_centroids(
    spark: SparkSession, seed: str, gazetteer: str, postal_file: str, overrides: str | None, out: str
) -> None:
    """Build the centroid file and the list of uncovered codes; fail when a code is left uncovered."""
    wanted = read_seed(spark, seed, exactly_five=True)
    first = read_gazetteer(spark, gazetteer, wanted)
    # The fallback source is read for the codes still needed only.
    needed = wanted.join(first.select("zip"), "zip", "left_anti")
    resolved = centroids.combine_sources(wanted, first, read_postal_file(spark, postal_file, needed))
    if overrides is not None:
        resolved, problems = centroids.resolve_overrides(resolved, read_overrides(spark, overrides))
        centroids.require_no_problems(problems)
    # Read back from the written table: sources and overrides are worked out once.
    resolved = write_table(resolved, out, "resolved_centroids")
    # At most 100,000 five-digit codes: single sorted files are fine.
    write_csv(centroids.centroid_table(resolved), f"{out}/zip_centroids", order_by=["zip"], single_file=True)
    missing = centroids.missing_codes(resolved)
    write_csv(missing, f"{out}/zip_centroids_missing", order_by=["zip"], single_file=True)
    counts = centroids.source_counts(resolved)
    write_run_metadata(counts, f"{out}/centroid_meta")
    require_clean(
        counts.select(
            F.lit("zip_centroids").alias("table_name"),
            F.lit("codes without centroid").alias("check_name"),
            F.col("still_missing").alias("failures"),
        )
    )


def existing_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The contracted tables that have been written."""
    found = {}
    for name in contract_tables():
        try:
            found[name] = read_table(spark, out, name)
        except AnalysisException:
            continue
    return found


def run_validation(spark: SparkSession, out: str, contracts: str) -> DataFrame:
    """Contracts and quality checks over the written tables.

    Returns every failure as ``(table_name, check_name, failures)``; an empty frame means all passed. The
    quality suite needs all tables, so it is left out when the contracts find one missing.
    """
    tables = existing_tables(spark, out)
    broken = (
        quality.contract_check(read_contracts(spark, contracts), tables)
        .filter(F.col("problems") != "")
        .select(
            "table_name",
            F.concat_ws(": ", "column_name", "problems").alias("check_name"),
            F.greatest("null_rows", F.lit(1)).cast("long").alias("failures"),
        )
    )
    if len(tables) < len(contract_tables()):
        return broken
    return broken.unionByName(quality.quality_suite(tables).filter(F.col("failures") > 0))


def run_all(
    spark: SparkSession, inputs: Inputs, out: str, home_zip: str, hot_key_rows: int = warehouse.HOT_KEY_ROWS
) -> None:
    """All stages in order. Any failed check stops the run.

    Serials with more than ``hot_key_rows`` violations are numbered by a distributed sort.
    """
    known = run_area(spark, inputs, out)
    known |= run_staging(spark, out, known)
    known |= run_warehouse(spark, out, hot_key_rows, known)
    known |= run_marts(spark, out, known)
    run_geo(spark, out, read_centroids(spark, inputs.centroids), home_zip, known)
    run_search(spark, out)
