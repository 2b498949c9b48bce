"""Shards of shuffled documents by a two-pass external shuffle.

First pass: a seeded hash of the id picks the shard, a seeded hash of the row one of the shard's buckets, each small
enough for a task's memory. Second pass: every bucket is put in order by a Fisher-Yates shuffle and written.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kitchenlight.llm.common import scratch_path

SHARDS = 24
SEED = 20_240
BUCKET_BYTES = 16 << 20


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose hash with the id is greatest. One shard more can only win rows, never move others."""
    return F.array_max(F.array(*(F.struct(F.xxhash64(doc_id, F.lit(s), F.lit(seed)).alias("h"), F.lit(s).alias("s")) for s in range(shards))))["s"]


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text and eight for the id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def fisher_yates(count: int, seed: int) -> list[int]:
    """A uniform permutation of ``range(count)``."""
    order = list(range(count))
    rng = np.random.default_rng(seed)
    draws = rng.integers(0, np.arange(count, 0, -1), dtype=np.int64).tolist() if count else []
    for i, draw in zip(range(count - 1, 0, -1), draws):
        order[i], order[draw] = order[draw], order[i]
    return order


def _shuffle_bucket(seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def compute(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text_crc32", "row_mark"], ignore_index=True)
        mark = f"{seed}:{rows['shard'].iloc[0]}:{rows['bucket'].iloc[0]}"
        shuffled = rows.iloc[fisher_yates(len(rows), zlib.crc32(mark.encode()))]
        return shuffled.assign(place=np.arange(len(rows), dtype=np.int64)).drop(columns="row_mark")

    return compute


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` to ``path/shard=N`` and return ``(doc_id, size, text_crc32, shard, slot)`` of what was written.

    ``docs`` should be a stored table, as the row's place in it tells repeated rows apart. The columns doc_id and text are
    written; a shard's buckets follow one another by number, and ``slot`` counts its rows from 0 in that order.
    A null text counts as empty in size and checksum and is written as null. All rows without an id share a shard, as
    do all rows of an id; either may be split over many buckets. Extra columns are ignored; an empty table writes none.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", "text", row_bytes(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        shard_of(F.col("doc_id"), shards, seed).alias("shard"),
    )
    sizes = rows.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()  # one row per shard
    buckets = F.lit(1)
    for row in sizes:
        buckets = F.when(F.col("shard") == row.shard, -(-row.bytes // bucket_bytes)).otherwise(buckets)
    marked = rows.withColumn("row_mark", F.xxhash64("doc_id", "text_crc32", F.monotonically_increasing_id(), F.lit(seed)))
    scattered = marked.withColumn("bucket", F.pmod("row_mark", buckets).cast("int"))
    shape = "doc_id long, text string, size long, text_crc32 long, shard int, bucket int, place long"
    shuffled = scattered.groupBy("shard", "bucket").applyInPandas(_shuffle_bucket(seed), shape)
    shuffled.write.partitionBy("shard").parquet(path)

    written = spark.read.schema(shape).parquet(path).drop("text")
    counts = written.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    begins = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("begin"))
    return written.join(begins, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("place")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``write_shards`` into a new folder, with the shard each would have if there were one more."""
    found = write_shards(docs, scratch_path(docs.sparkSession, "shards"), shards, seed, bucket_bytes)
    return found.withColumn("grown_shard", shard_of(F.col("doc_id"), shards + 1, seed))
