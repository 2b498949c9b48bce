"""Readers and writers, and the pipeline from landed files."""

import json

import pytest
from pyspark.sql import functions as F

from kitchenlight.plans.pipeline import Inputs, run_all, run_centroids, run_validation
from kitchenlight.schemas import contract_tables
from kitchenlight.sources import delimited, metadata
from kitchenlight.sources import sample_binding as bind
from kitchenlight.sources.manifest import EmptyDataset, landing_manifest, require_records
from kitchenlight.sources.tables import EmptyOutput, write_counted, write_table
from kitchenlight.operators.audits import AuditFailure
from tests.conftest import SMALL


def test_extract_with_quoted_newlines(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('A,B\n"x\ny","say ""hi"""\n z ,\n')
    rows = [tuple(r) for r in delimited.read_extract(spark, str(path), multi_line=True).collect()]
    assert rows == [("x\ny", 'say "hi"'), (" z ", None)]
    # Without the parameter a broken record fails the job, so no row is lost unseen.
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        delimited.read_extract(spark, str(path)).collect()
    path.write_text('A,B\n1,2\n"3,4\n5,6\n')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        delimited.read_extract(spark, str(path)).collect()


def test_plain_extract_stays_splittable_and_strict(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("A,B\n1,2\n3\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        delimited.read_extract(spark, str(path)).collect()
    with pytest.raises(delimited.SchemaError, match="C"):
        delimited.read_extract(spark, str(path), ["A", "C"])


def test_seed_files(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(' ZIP \n91754\n 91801-1234 \n\n12\n91754\n91,803\n"91804",x\n')
    assert sorted(r.zip for r in delimited.read_seed(spark, str(path)).collect()) == ["91754", "91801", "91803", "91804"]
    assert sorted(r.zip for r in delimited.read_seed(spark, str(path), exactly_five=True).collect()) == ["91754", "91803", "91804"]
    path.write_text("")
    with pytest.raises(delimited.SchemaError, match="single header"):
        delimited.read_seed(spark, str(path))
    path.write_text("code\n91754\n")
    with pytest.raises(delimited.SchemaError, match="single header"):
        delimited.read_seed(spark, str(path))
    path.write_text("zip\nabc\n")
    with pytest.raises(delimited.SchemaError, match="no five-digit"):
        delimited.read_seed(spark, str(path))


def test_gazetteer_last_row_counts(spark, tmp_path):
    path = tmp_path / "gaz.txt"
    path.write_text("GEOID\tX\tINTPTLAT\tINTPTLONG   \n1\ta\t10\t20  \n2\ta\t1\t1\n1\ta\t11\t21\n")
    wanted = spark.createDataFrame([("1",)], "zip string")
    assert [tuple(r) for r in delimited.read_gazetteer(spark, str(path), wanted).collect()] == [("1", "11", "21")]
    path.write_text("GEOID\tX\n1\ta\n")
    with pytest.raises(delimited.SchemaError, match="INTPTLAT"):
        delimited.read_gazetteer(spark, str(path), wanted)


def test_postal_file_first_complete_row_counts(spark, tmp_path):
    path = tmp_path / "US.txt"
    row = "US\t{}\tp\tn\tc\tn\tc\tn\tc\t{}\t{}\t4\n"
    path.write_text("US\t1\tshort\n" + row.format("1", "", "5") + row.format("1", "10", "20") + row.format("1", "11", "21"))
    wanted = spark.createDataFrame([("1",)], "zip string")
    assert [tuple(r) for r in delimited.read_postal_file(spark, str(path), wanted).collect()] == [("1", "10", "20")]


def test_contract_files(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"table": "t", "path": "p", "columns": [{"name": "a", "type": "varchar", "not_null": True}, {"name": "b", "type": "DATE"}]}, indent=2))
    rows = [tuple(r) for r in metadata.read_contracts(spark, str(tmp_path)).orderBy("column_name").collect()]
    assert rows == [("t", "a", "VARCHAR", True), ("t", "b", "DATE", False)]
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception):
        metadata.read_contracts(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    ("stamp", "shown"),
    [("2024-08-01T23:30:00.123456+00:00", "Aug 01, 2024"), ("2024-08-01T01:30:00Z", "Aug 01, 2024"), ("yesterday evening", "yesterday "), ("", "N/A"), (None, "N/A")],
)
def test_last_updated(spark, tmp_path, stamp, shown):
    (tmp_path / "m.json").write_text(json.dumps({"generated_at_utc": stamp, "x": 1}, indent=2))
    assert metadata.read_run_metadata(spark, str(tmp_path)).first().last_updated == shown


def test_metadata_without_stamp(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"x": 1}')
    assert metadata.read_run_metadata(spark, str(tmp_path)).first().last_updated == "N/A"


def test_empty_outputs_fail(spark, tmp_path):
    with pytest.raises(EmptyOutput):
        write_table(spark.createDataFrame([], "a int"), str(tmp_path), "t")
    (tmp_path / "e.csv").write_text("A\n")
    (tmp_path / "f.csv").write_text("A\n1\n")
    frames = {name: delimited.read_extract(spark, str(tmp_path / f"{name}.csv")) for name in "ef"}
    counted = {r.dataset: (r.row_count, r.byte_count) for r in landing_manifest(frames).collect()}
    assert counted == {"e": (0, 2), "f": (1, 4)}
    with pytest.raises(EmptyDataset, match="'e'"):
        require_records(landing_manifest(frames))


def landed(spark, folder, keep):
    raw = bind.bind_raw_inspections(spark, SMALL).filter(keep)
    delimited.write_csv(raw, f"{folder}/inspections")
    delimited.write_csv(bind.bind_raw_violations(spark, SMALL), f"{folder}/violations")
    delimited.write_csv(bind.bind_area_seed(spark, SMALL), f"{folder}/seed")
    delimited.write_csv(bind.bind_zip_geo(spark, SMALL), f"{folder}/centroids", order_by=["zip"], single_file=True)
    return Inputs(*[f"{folder}/{name}" for name in ("inspections", "violations", "seed", "centroids")])


def test_pipeline_from_landed_files(spark, tmp_path):
    inputs = landed(spark, tmp_path, F.col("ACTIVITY DATE") != "13/45/2024")
    # One serial in seven is written without padding; trimmed staging then finds it, so no orphan is left.
    out = str(tmp_path / "out")
    run_all(spark, inputs, out, "91705")
    tables = {name: spark.read.parquet(f"{out}/{name}") for name in contract_tables()}
    contracts = str(tmp_path / "contracts")
    metadata.write_contracts(spark, contracts)
    assert run_validation(spark, out, contracts).count() == 0
    meta = spark.read.json(f"{out}/marts_meta").first()
    assert meta.outputs.mart_facility_health_rows == tables["mart_facility_health"].count()
    assert meta.cleanliness_index_stats.p90 > meta.cleanliness_index_stats.p50
    assert meta.facility_distribution.good_70_89 + meta.facility_distribution.excellent_ge90 <= meta.outputs.mart_facility_health_rows
    report = spark.read.json(f"{out}/core_meta").first().facility_merge_report
    assert report.merge_rate < 0.05
    assert [r.facility_id_count for r in report.top_merged_facilities] == [2] * len(report.top_merged_facilities)
    area_meta = spark.read.json(f"{out}/area_meta").first()
    assert area_meta.seed_zip_count == 20
    coverage = spark.read.csv(f"{out}/zip_coverage", header=True, inferSchema=True)
    assert coverage.agg(F.sum("inspection_count")).first()[0] == area_meta.outputs.inspection_rows


def test_validation_reports_missing_tables_and_types(spark, tmp_path):
    write_table(spark.createDataFrame([(1, 34.0, None)], "zip int, lat double, lon double"), str(tmp_path), "dim_zip_geo")
    contracts = str(tmp_path / "contracts")
    metadata.write_contracts(spark, contracts, ["dim_zip_geo", "fct_violation"])
    found = {(r.table_name, r.check_name) for r in run_validation(spark, str(tmp_path), contracts).collect()}
    assert ("dim_zip_geo", "zip: wrong type") in found and ("dim_zip_geo", "lon: unexpected nulls") in found
    assert ("fct_violation", "points: missing table") in found and len(found) == 9


def test_centroid_build(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("zip\n11111\n22222\n33333\n123456\n")
    (tmp_path / "gaz.txt").write_text("GEOID\tINTPTLAT\tINTPTLONG  \n11111\t34.1\t-118.1\n")
    row = "US\t{}\tp\tn\tc\tn\tc\tn\tc\t{}\t{}\t4\n"
    (tmp_path / "US.txt").write_text(row.format("22222", "34.3", "-118.3") + row.format("11111", "0", "0"))
    (tmp_path / "rules.csv").write_text('zip,method,neighbors,source_note\n33333,mean_neighbors,"11111|22222","a, b"\n')
    paths = [str(tmp_path / name) for name in ("seed.csv", "gaz.txt", "US.txt")]
    run_centroids(spark, *paths, str(tmp_path / "rules.csv"), str(tmp_path / "out"))
    built = delimited.read_centroids(spark, str(tmp_path / "out/zip_centroids")).collect()
    assert [tuple(r) for r in built] == [("11111", 34.1, -118.1), ("22222", 34.3, -118.3), ("33333", 34.2, -118.2)]
    with pytest.raises(AuditFailure, match="codes without centroid = 1"):
        run_centroids(spark, *paths, None, str(tmp_path / "out2"))
    assert [r.zip for r in spark.read.csv(str(tmp_path / "out2/zip_centroids_missing"), header=True).collect()] == ["33333"]


def test_pipeline_stops_on_bad_dates(spark, tmp_path):
    inputs = landed(spark, tmp_path, F.lit(True))
    with pytest.raises(AuditFailure, match="activity_date missing"):
        run_all(spark, inputs, str(tmp_path / "out"), "91705")


def test_counts_come_from_the_writing_job(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN NULL ELSE id END AS value").repartition(7)
    counts = {"value missing": F.count_if(F.col("value").isNull()), "negative": F.count_if(F.col("value") < 0)}
    before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    written = write_counted(rows, str(tmp_path), "t", counts)
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() - before
    assert (written.rows, written.counts) == (1000, {"value missing": 100, "negative": 0})
    assert written.table.count() == 1000
    assert jobs <= 3  # the shuffle, the write, the schema of the files read back


def test_counts_of_a_clustered_table_are_not_taken_twice(spark, tmp_path):
    written = write_counted(spark.range(5000).selectExpr("id", "id % 7 AS day"), str(tmp_path), "t", {"late": F.count_if(F.col("day") > 3)}, ["day", "id"])
    assert (written.rows, written.counts["late"]) == (5000, written.table.filter("day > 3").count())


def test_hashes_are_stored_in_about_half_their_text(spark, tmp_path):
    hashes = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("violation_key"))
    write_table(hashes.coalesce(1), str(tmp_path), "hashes")
    assert sum(part.stat().st_size for part in (tmp_path / "hashes").glob("*.parquet")) < 20_000 * 64 * 0.7
