"""Operators on small frames, the paths for hot keys included."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kitchenlight.operators import ordinals, quantiles
from kitchenlight.operators.audits import AuditFailure, count_checks, duplicate_count, orphan_count, require_clean
from kitchenlight.operators.latest import pack_day_and_int, unpack_int
from kitchenlight.operators.quantiles import exact_quantiles
from kitchenlight.operators.ranking import direction, top_rows, top_rows_per_key


def order():
    blank = F.lit("")
    return [("code", F.coalesce("code", blank)), ("points", F.coalesce(F.col("points").cast("string"), blank))]


def violation_rows(spark):
    rng = random.Random(7)
    rows = [("hot", rng.choice(["a", "b", "c", None]), rng.choice([None, 1.0, 2.0])) for _ in range(400)]
    rows += [("hot2", "a", 1.0)] * 90
    rows += [(f"s{rng.randrange(40)}", rng.choice(["a", "b"]), float(rng.randrange(3))) for _ in range(100)]
    return spark.createDataFrame(rows, "serial string, code string, points double").repartition(5)


def collected(df):
    return sorted(tuple(map(str, r)) for r in df.select("serial", "code", "points", "ordinal").collect())


def test_hot_keys_are_numbered_like_any_other(spark, monkeypatch):
    df = violation_rows(spark)
    plain = collected(ordinals.number_rows(df, "serial", order()))
    monkeypatch.setattr(ordinals, "RUN_CHUNK", 7)
    assert collected(ordinals.number_rows(df, "serial", order(), hot_key_rows=50)) == plain
    by_serial = {}
    for serial, _, _, ordinal in plain:
        by_serial.setdefault(serial, []).append(int(ordinal))
    assert all(sorted(found) == list(range(1, len(found) + 1)) for found in by_serial.values())


def test_hot_path_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "a", 1.0)] * 5 + [("x", "a", 1.0)] * 9, "serial string, code string, points double")
    assert ordinals.number_rows(df, "serial", order(), hot_key_rows=3).count() == 14


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [100.0] * 9 + [99.99], list(range(101)), [-5.0, 250.0, 3.0, None]])
def test_quantiles_equal_linear_interpolation(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    known = [v for v in values if v is not None]
    fractions = {"q0": 0.0, "q3": 0.3, "q5": 0.5, "q9": 0.9, "q1": 1.0}
    row = exact_quantiles(df, "x", fractions).first()
    for name, q in fractions.items():
        assert row[name] == pytest.approx(np.quantile(known, q), abs=1e-12)


def test_quantiles_of_values_inside_one_cell(spark):
    values = [50 + i * 1e-9 for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert exact_quantiles(df, "x", {"q": 0.75}).first().q == pytest.approx(np.quantile(values, 0.75), abs=1e-13)


def test_quantiles_far_outside_any_range_with_a_third_equal(spark, monkeypatch):
    rng = random.Random(3)
    values = [7.25] * 1000 + [rng.uniform(0, 100) for _ in range(900)] + [10.0 ** rng.randint(-300, 300) for _ in range(600)]
    values += [-(10.0 ** rng.randint(-300, 300)) for _ in range(500)] + [5e-324, -5e-324, 0.0, -0.0, 1.7e308, -1.7e308]
    fractions = {f"q{i}": i / 20 for i in range(21)}
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    want = df.agg(*[F.percentile("x", q).alias(name) for name, q in fractions.items()]).first()
    for most in (1, 50, quantiles.RANK_VALUES):
        monkeypatch.setattr(quantiles, "RANK_VALUES", most)
        row = exact_quantiles(df, "x", fractions).first()
        assert row.asDict() == pytest.approx(want.asDict(), rel=1e-12)


def test_quantile_passes_end_in_ranges_of_few_values(spark, monkeypatch):
    """Neighbouring doubles, each many times: all passes are needed, and none leaves more than two values to rank."""
    near = [np.nextafter(3.0, 4.0), 3.0, np.nextafter(3.0, 2.0), 2.0000001, 3.9999999]
    df = spark.createDataFrame([(float(v),) for v in near for _ in range(40)], "x double")
    left = []
    ranked = quantiles._ranked
    monkeypatch.setattr(quantiles, "RANK_VALUES", 10)
    monkeypatch.setattr(quantiles, "_ranked", lambda values, targets: left.extend(targets) or ranked(values, targets))
    fractions = {f"q{i}": i / 10 for i in range(11)}
    row = exact_quantiles(df, "x", fractions).first()
    expanded = sorted(v for v in near for _ in range(40))
    assert row.asDict() == {name: pytest.approx(np.quantile(expanded, q), rel=1e-15) for name, q in fractions.items()}
    assert all(np.nextafter(t.low, t.high) == t.high for t in left)


def test_quantiles_with_infinities_and_nan(spark):
    values = [float("-inf")] * 3 + [1.0, 2.0, 3.0] + [float("inf")] * 2 + [float("nan")]
    row = exact_quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", {"a": 0.0, "b": 0.5, "c": 0.8, "d": 1.0}).first()
    assert (row.a, row.b) == (float("-inf"), 2.0) and row.c == float("inf") and np.isnan(row.d)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "x double"), "x", {"q": 0.5}).first().q is None


def test_packed_latest_value(spark):
    rows = [("2024-01-01", 99), ("2024-01-02", 80), ("2024-01-02", -3), ("2024-01-03", None), (None, 1)]
    df = spark.createDataFrame(rows, "d string, v int").withColumn("d", F.col("d").cast("date"))
    assert df.agg(unpack_int(F.max(pack_day_and_int(F.col("d"), F.col("v")))).alias("v")).first().v == -3


def test_top_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 3)], "k string, v int")
    assert [r.k for r in top_rows(df, [direction("v", True), F.col("k").asc()], 3).collect()] == ["c", "d", "a"]
    assert [r.k for r in top_rows(df, [direction("v", False), F.col("k").asc()], 4).collect()] == ["a", "c", "d", "b"]


def test_top_rows_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    top = top_rows_per_key(df, "k", [F.col("id").desc()], 2)
    # Planned twice: once per task before the exchange, once after it.
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted(r.id for r in top.collect()) == [994, 995, 996, 997, 998, 999]


def test_orphans_follow_not_in(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert orphan_count(child, parent, "k").first().failures == 2
    with_null = spark.createDataFrame([("a",), (None,)], "k string")
    assert orphan_count(child, with_null, "k").first().failures == 0


def test_duplicates_count_null_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    checks = count_checks(df, "t", {"k duplicated": duplicate_count("k")})
    assert checks.first().failures == 2
    with pytest.raises(AuditFailure, match="t: k duplicated = 2"):
        require_clean(checks)
