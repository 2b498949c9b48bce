"""Row numbers inside a key, for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kitchenlight.session import cut_lineage

# A key up to this many rows is numbered by a plain window, which spills; larger ones are split. The rows are the same.
HOT_KEY_ROWS = 1_000_000
# Rows made by one task when a run of identical rows is written out again.
RUN_CHUNK = 1_000_000


def split_hot_keys(
    df: DataFrame, key: str, hot_key_rows: int = HOT_KEY_ROWS
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """``df`` without its hot keys, the rows of the hot keys, and the hot keys themselves.

    Keys are counted with map-side combine over the key column alone, in a job of its own. Without hot keys, the
    usual case, the frame comes back as it is with two ``None``. There is at most one hot key in ``hot_key_rows`` rows
    (a million of them in 10^12), so their table can always be broadcast.
    """
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).filter(F.col("key_rows") > hot_key_rows).select(key)
    if hot.isEmpty():
        return df, None, None
    hot = cut_lineage(hot)
    joined = F.broadcast(hot)
    return df.join(joined, key, "left_anti"), df.join(joined, key, "left_semi"), hot


def number_rows(
    df: DataFrame, key: str, order: Sequence[tuple[str, Column]], hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Add ``ordinal``: 1, 2, ... inside each ``key`` in the given order, remaining columns breaking ties.

    ``order`` pairs a name with the expression sorted on. Rows equal in every column are interchangeable.
    Keys larger than ``hot_key_rows`` are numbered by a distributed sort and running counts, the others by
    one window.
    """
    cold, hot_rows, _ = split_hot_keys(df, key, hot_key_rows)
    numbered = number_by_window(cold, key, order)
    return numbered if hot_rows is None else numbered.unionByName(number_by_sort(hot_rows, key, order))


def _sort_columns(df: DataFrame, key: str, order: Sequence[tuple[str, Column]]) -> list[Column]:
    named = {name for name, _ in order} | {key}
    rest = [F.col(name) for name in sorted(df.columns) if name not in named]
    return [expression for _, expression in order] + rest


def number_by_window(df: DataFrame, key: str, order: Sequence[tuple[str, Column]]) -> DataFrame:
    in_key = W.partitionBy(key).orderBy(*_sort_columns(df, key, order))
    return df.withColumn("ordinal", F.row_number().over(in_key).cast("long"))


def number_by_sort(df: DataFrame, key: str, order: Sequence[tuple[str, Column]]) -> DataFrame:
    """Number rows by a range-partitioned sort: no task holds a whole key."""
    # Identical rows collapse to one with a count, so a run of them cannot fill one range.
    runs = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("run"))
    sort_by = [F.col(key), *_sort_columns(df, key, order)]
    # The range bounds come from a sample; storing the partitions keeps them the same for both uses below.
    placed = cut_lineage(runs.repartitionByRange(*sort_by).withColumn("part", F.spark_partition_id()))

    part_key = W.partitionBy(key, "part")
    upto = part_key.orderBy(*_sort_columns(df, key, order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = placed.withColumn("upto", F.sum("run").over(upto))
    # One row per key and range: the window over a key is bounded by the number of ranges.
    before = W.partitionBy(key).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(key, "part")
        .agg(F.sum("run").alias("part_rows"))
        .select(key, "part", F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("offset"))
    )
    numbered = local.join(offsets, [key, "part"]).withColumn("first", F.col("offset") + F.col("upto") - F.col("run"))

    # Write runs out again, long ones in chunks spread over the tasks.
    chunk_start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("run") - 1, F.lit(RUN_CHUNK).cast("long")))
    chunks = numbered.select("*", chunk_start.alias("chunk_start")).repartition(key, "first", "chunk_start")
    last = F.least(F.col("run") - 1, F.col("chunk_start") + (RUN_CHUNK - 1))
    step = F.explode(F.sequence(F.col("chunk_start"), last))
    return chunks.select(*df.columns, "first", step.alias("step")).select(
        *df.columns, (F.col("first") + F.col("step") + 1).alias("ordinal")
    )
