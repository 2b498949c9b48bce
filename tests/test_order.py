"""Order of whole tables, the reach of the best near-me scores, and columns that sources lack."""

import random

import pytest
from pyspark.sql import functions as F

from kitchenlight.functions import distance_discount
from kitchenlight.operators.sequence import descents, file_positions, positions
from kitchenlight.plans import geo
from kitchenlight.sources import delimited
from kitchenlight.sources.tables import write_table


def spread(spark, values, parts=7):
    return spark.createDataFrame([(v,) for v in values], "v int").repartition(parts)


def test_positions_follow_the_sort(spark):
    values = [random.Random(1).randrange(50) for _ in range(400)]
    found = sorted((r.position, r.v) for r in positions(spread(spark, values).orderBy("v")).collect())
    assert found == list(enumerate(sorted(values), 1))
    backwards = positions(spread(spark, values).orderBy(F.col("v").desc())).orderBy("position")
    assert [r.v for r in backwards.collect()] == sorted(values, reverse=True)


def test_positions_of_nothing(spark):
    empty = spread(spark, []).orderBy("v")
    assert positions(empty).collect() == [] and descents(empty, "v").first().descents == 0


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_descents_equal_a_plain_count(spark, parts):
    values = [random.Random(2).choice([None, *range(9)]) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(values)), "place int, v int").repartition(parts)
    known = [-1 if v is None else v for v in values]
    want = sum(a > b for a, b in zip(known, known[1:]))
    # Every row its own range in one case: then only the ends are compared.
    ordered = rows.repartitionByRange(parts * 10, "place").sortWithinPartitions("place")
    assert descents(ordered, "v").first().descents == want
    assert descents(ordered, "place").first().descents == 0


def test_descents_between_parts_are_seen(spark):
    halves = spark.createDataFrame([(i, v) for i, v in enumerate([5, 6, 1, 2])], "place int, v int")
    ordered = halves.repartitionByRange(2, "place").sortWithinPartitions("place")
    assert descents(ordered, "v").first().descents == 1


def test_written_files_keep_the_order(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i:05d}", 1.0, 2.0) for i in range(3000)], "zip string, lat double, lon double")
    path = str(tmp_path / "centroids")
    delimited.write_csv(rows.repartition(6), path, order_by=["zip"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = delimited.read_centroid_lines(spark, path)
        found = {(r.position, r.zip) for r in file_positions(lines, "line_no").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {(i + 1, f"{i:05d}") for i in range(3000)}


# ---- near me ----


def near_rows(spark, rows):
    schema = "facility_key string, cleanliness_index double, distance_miles double"
    df = spark.createDataFrame(rows, schema).withColumn(
        "near_me_score", distance_discount(F.col("cleanliness_index"), F.col("distance_miles"))
    )
    text = {name: F.col("facility_key") for name in ("facility_name", "facility_city", "facility_zip5")}
    return df.withColumns(text)


def plain_top(df, n):
    rated = [r for r in df.collect() if r.cleanliness_index is not None]
    score = lambda r: (r.near_me_score is None, -(r.near_me_score or 0), r.facility_key)
    return [r.facility_key for r in sorted(rated, key=score)[:n]]


@pytest.mark.parametrize("seed", range(3))
def test_best_near_me_equal_a_plain_ranking(spark, seed):
    rng = random.Random(seed)
    miles = lambda: rng.choice([0.0, 1.0, 3.0, rng.uniform(0, 5), rng.uniform(0, 12000), None])
    df = near_rows(spark, [(f"k{i:03d}", rng.choice([None, 100.0, 0.0, rng.uniform(0, 100)]), miles()) for i in range(200)])
    for n in (1, 25, 180):
        assert [r.facility_name for r in geo.near_me_top(df, n).collect()] == plain_top(df, n)


def test_ties_at_the_edge_of_a_ring_are_kept(spark):
    df = near_rows(spark, [("b", 100.0, 1.0), ("a", 100.0, 1.0), ("c", 50.0, 0.0)])
    assert geo.reach(df, 1) == 3
    assert [r.facility_name for r in geo.near_me_top(df, 2).collect()] == ["a", "b"]


def test_rows_beyond_reach_are_not_read(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"k{i:05d}", rng.uniform(60, 100), 12000 * rng.random() ** 4) for i in range(20000)]
    near = write_table(near_rows(spark, rows), str(tmp_path), "near", ["distance_miles", "facility_key"])
    limit = geo.reach(near, 25)
    within = sum(miles < limit for _, _, miles in rows)
    assert limit is not None and 25 <= within < len(rows) / 4
    top = geo.near_me_top(near)
    assert [r.facility_name for r in top.collect()] == plain_top(near, 25)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert f"LessThan(distance_miles,{float(limit)})" in plan


# ---- columns ----


def test_lacking_columns(spark):
    one, two = spread(spark, [1, 2, 3]), spark.createDataFrame([("x", 1)], "a string, b int")
    found = delimited.lacking_columns({"one": (one, ("v", "w", "u")), "two": (two, ("a", "b"))})
    assert sorted(map(tuple, found.collect())) == [("one", 3, "u"), ("one", 3, "w")]
