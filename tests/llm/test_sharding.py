"""Shards: the law, gapless slots, whole texts written, uniform shuffles."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kitchenlight.llm import sharding
from kitchenlight.llm.common import scratch_path

SCHEMA = "doc_id long, text string, shard string, size int, bucket int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "é" * (i % 50), "clash", 1, 2) for i in range(600)]
    rows += [(7, "same", None, None, None)] * 300 + [(None, "no id", None, None, None)] * 5 + [(600, None, None, None, None), (601, "x" * 200_000, None, None, None)]
    path = scratch_path(spark, "sharding")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return rows, spark.read.parquet(path)


@pytest.mark.parametrize("bucket_bytes", [sharding.BUCKET_BYTES, 900])
def test_rows_law_and_slots(docs, bucket_bytes):
    rows, table = docs
    found = sharding.shard_documents(table, bucket_bytes=bucket_bytes).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    slots, by_id = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        by_id[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, sharding.SHARDS)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(sharding.SHARDS))
    assert all(len(s) == 1 for s in by_id.values())
    moved = sum(a != b for s in by_id.values() for a, b in s)
    assert 0 < moved < 3 * len(by_id) / (sharding.SHARDS + 1)


def test_written_texts(spark, docs):
    rows, table = docs
    path = scratch_path(spark, "written")
    sharding.write_shards(table, path, bucket_bytes=900)
    written = spark.read.parquet(path).select("doc_id", "text").collect()
    assert Counter(map(tuple, written)) == Counter(r[:2] for r in rows)


def test_more_shards_take_rows_only_into_themselves(spark):
    ids = spark.range(3000)
    for n in (1, 2, 7, 24):
        moved = ids.filter(sharding.shard_of(F.col("id"), n) != sharding.shard_of(F.col("id"), n + 1))
        assert moved.filter(sharding.shard_of(F.col("id"), n + 1) != n).count() == 0


def test_fisher_yates_is_a_uniform_permutation():
    seen = Counter(tuple(sharding.fisher_yates(3, seed)) for seed in range(3000))
    assert len(seen) == 6 and min(seen.values()) > 400
    assert sharding.fisher_yates(0, 1) == [] and sharding.fisher_yates(1, 1) == [0]
    assert sharding.fisher_yates(50, 9) == sharding.fisher_yates(50, 9)


def test_empty_table(spark):
    assert sharding.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
