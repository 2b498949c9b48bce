"""The order of whole tables: positions and out-of-order rows, with no task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kitchenlight.session import cut_lineage

# Fixed value: bits of monotonically_increasing_id that number the rows of one partition.
ROW_BITS = 33


def _placed(df: DataFrame) -> DataFrame:
    """``df`` stored as it lies, with its partition (``part__``) and row inside it (``place__``)."""
    row = F.monotonically_increasing_id()
    numbered = df.select(
        "*", F.shiftright(row, ROW_BITS).alias("part__"), row.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("place__")
    )
    # The bounds of a sort come from a sample: storing the rows keeps them the same for every use.
    return cut_lineage(numbered)


def _offsets(rows: DataFrame, *split: str) -> DataFrame:
    """Rows ahead of each split. One row per split, so the unpartitioned window is bounded by their number."""
    ahead = W.orderBy(*split).rowsBetween(W.unboundedPreceding, -1)
    counted = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("n__"))
    return counted.select(*split, F.coalesce(F.sum("n__").over(ahead), F.lit(0)).alias("offset__"))


def positions(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of an ordered frame 1, 2, ... as they come.

    ``ordered`` is a frame that ends in ``orderBy``; nothing is sorted again, so the numbers show the order it has.
    """
    placed = _placed(ordered)
    numbered = placed.join(_offsets(placed, "part__"), "part__")
    return numbered.select(*ordered.columns, (F.col("offset__") + F.col("place__") + 1).alias(name))


def file_positions(rows: DataFrame, line_order: str, name: str = "position") -> DataFrame:
    """Number the rows of files read back 1, 2, ... in the order of the files and of the lines in them.

    ``line_order`` is the struct ``file, split_start, row`` of a delimited reader. Rows of one split lie in one task, so
    their row numbers there have no gaps; splits are counted, not sorted.
    """
    split = {"file__": F.col(f"{line_order}.file"), "start__": F.col(f"{line_order}.split_start")}
    lines = rows.withColumns(split)
    first = lines.groupBy(*split).agg(F.min(f"{line_order}.row").alias("first__"))
    placed = lines.join(first, list(split)).join(_offsets(lines, *split), list(split))
    position = F.col("offset__") + F.col(f"{line_order}.row") - F.col("first__") + 1
    kept = [column for column in rows.columns if column != line_order]
    return placed.select(*kept, position.alias(name))


def descents(ordered: DataFrame, *key: Column | str) -> DataFrame:
    """One row ``descents``: how many rows of a frame come before their predecessor by ``key``, NULL first.

    Zero for a frame in order of the key. Rows are compared inside their partition, partitions by their ends.
    """
    placed = _placed(ordered.select(F.struct(*key).alias("key__")))
    inside = W.partitionBy("part__").orderBy("place__")
    falls = placed.withColumn("prior__", F.lag("key__").over(inside)).agg(F.count_if(F.col("prior__") > F.col("key__")).alias("inner"))
    # One row per partition.
    ends = placed.groupBy("part__").agg(F.min_by("key__", "place__").alias("low"), F.max_by("key__", "place__").alias("high"))
    across = ends.withColumn("prior__", F.lag("high").over(W.orderBy("part__"))).agg(
        F.count_if(F.col("prior__") > F.col("low")).alias("outer")
    )
    return falls.crossJoin(F.broadcast(across)).select((F.col("inner") + F.col("outer")).alias("descents"))
