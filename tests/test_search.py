"""Text search through trigram lists, and lookups of one key: same rows as a scan, less read."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kitchenlight.plans import search, serving
from kitchenlight.schemas import column_names
from kitchenlight.sources.tables import read_table, write_table

TEXTS = (
    "taco", " TACO ", "o b", "ÉCL", "%", "_", "ta", "", "a%o", "ta_o shop", "no such text", "91703", "917", "1703", "\\x", "10%", "street",
    "Σίσυ", "%%%", "straße", "12", "b\\", "grand ave",
)


def rows_read(df):
    """Rows that the scan of a plan without exchanges gave on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def mart(spark):
    rng = random.Random(4)
    words = ["Taco", "tACO Shop", "Éclair", "Burger", "ΣΊΣΥΦΟΣ", "10% off", "Straße", "b\\x", "Grand Ave", "Street", "91703 Grill", "", None, "İzmir"]

    def text():
        parts = [w for w in (rng.choice(words) for _ in range(rng.randrange(4))) if w is not None]
        return " ".join(parts) if parts else rng.choice([None, ""])

    rows = []
    for i in range(600):
        zip5 = rng.choice(["91703", "91754", "", None, "taco"])
        name = "Taco 1" if i < 200 else text()  # a third of the rows has the same grams
        rows.append((hashlib.sha256(str(i).encode()).hexdigest(), name, text(), rng.choice(["Alhambra", "CITY 1", None]), zip5, float(i % 97), i % 4, i % 5 == 0))
    shape = "facility_key string, facility_name string, facility_address string, facility_city string, facility_zip5 string, cleanliness_index double, inspections_12mo int, low_data_flag boolean"
    made = spark.createDataFrame(rows, shape)
    return made.select("*", *[F.lit(None).cast("string").alias(c) for c in column_names("mart_facility_health") if c not in made.columns])


@pytest.fixture(scope="module")
def index(mart, tmp_path_factory):
    return search.write_index(mart, str(tmp_path_factory.mktemp("index")), blocks=16)


def test_trigrams(spark):
    df = spark.createDataFrame([("Taco",), ("ab",), (None,), ("aaaa",), ("é😀B c",)], "t string")
    assert [r[0] for r in df.select(search.trigrams(F.col("t"))).collect()] == [["tac", "aco"], [], [], ["aaa"], ["é😀b", "😀b ", "b c"]]
    assert search.needed_grams(spark, " Ta_coS%xyz ") == ["cos", "xyz"]


@pytest.mark.parametrize("text", TEXTS)
def test_search_finds_what_a_scan_finds(mart, index, text):
    def keys(df):
        return [r.facility_key for r in serving.search_facilities(df, text, n=1000).collect()]

    want = keys(mart)
    assert keys(search.possible_matches(index, text)) == want
    assert keys(search.possible_matches(index, text, most_broadcast=-1)) == want  # joined by shuffle


def test_candidates_are_few_and_counted(index):
    for text in ("grand ave", "91703", "no such text", "taco"):
        found, bound = search.candidates(index, text)
        assert found.count() <= bound
    assert search.candidates(index, "zzz")[0].count() == 0
    assert search.candidates(index, "ab") is None and search.candidates(index, "%__") is None


def test_only_blocks_of_candidates_are_read(mart, spark, tmp_path):
    one = mart.withColumn("facility_name", F.when(F.col("cleanliness_index") == 96.0, "Zebra").otherwise(F.col("facility_name")))
    wide = search.write_index(one, str(tmp_path), blocks=64)
    found = search.possible_matches(wide, "zebra")
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "dynamicpruning" in plan
    blocks = {r.block for r in wide.rows.filter("facility_name = 'Zebra'").collect()}
    assert 0 < len(blocks) < 16 and found.count() == one.filter("facility_name = 'Zebra'").count()


def test_one_key_reads_few_row_groups(spark, tmp_path):
    """Rows in the order of a date, keys at random: without filters every row group holds keys on both sides of the one wanted."""
    spark.range(40_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("facility_key"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 20).cast("int")).alias("activity_date"),
        F.sha2((-F.col("id")).cast("string"), 256).alias("filler"),
    ).createOrReplaceTempView("many")
    rows = spark.table("many")
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(256 * 1024))
    try:
        order = ["activity_date", "facility_key"]
        plain = write_table(rows, str(tmp_path), "plain", order)
        by_key = write_table(rows, str(tmp_path), "by_key", order, ["facility_key"])
        clustered = write_table(rows, str(tmp_path), "clustered", ["facility_key"], ["facility_key"])
    finally:
        hadoop.unset("parquet.block.size")
    key = hashlib.sha256(b"12345").hexdigest()
    read = [rows_read(df.filter(F.col("facility_key") == key)) for df in (plain, by_key, clustered)]
    assert read[1] < 0.35 * read[0] and read[2] < 0.35 * read[0]
    assert [df.filter(F.col("facility_key") == key).count() for df in (plain, by_key, clustered)] == [1, 1, 1]
    assert read_table(spark, str(tmp_path), "by_key").count() == 40_000
