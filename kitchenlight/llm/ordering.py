"""Neighbours in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kitchenlight.llm.common import stored


def with_neighbours(df: DataFrame, order: list[str], carry: list[str], last_takes_first: bool = False) -> DataFrame:
    """``df`` with ``before`` and ``after``: structs of the columns ``carry`` of the rows next to it in ``order``.

    The rows are dealt into ranges of the order and stored with their range, so every step sees the same ranges.
    Inside a range a window gives the neighbours; at its ends they come from the first and last rows of the ranges, a table
    with one row per partition. ``order`` should be unique up to rows that may change places; nulls come first.
    The ends of the whole order have null neighbours, or each other with ``last_takes_first``.
    """
    ranged = stored(df.repartitionByRange(*order).withColumn("range_no", F.spark_partition_id()), "ranges")
    row, key = F.struct(*carry), F.struct(*order)
    by_order = Window.partitionBy("range_no").orderBy(*order)
    near = ranged.withColumn("before", F.lag(row).over(by_order)).withColumn("after", F.lead(row).over(by_order))
    ends = ranged.groupBy("range_no").agg(F.min_by(row, key).alias("head"), F.max_by(row, key).alias("tail"))
    seam = Window.orderBy("range_no")  # over as many rows as there are partitions
    last, first = F.lag("tail").over(seam), F.lead("head").over(seam)
    if last_takes_first:
        every = seam.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        last, first = F.coalesce(last, F.last("tail").over(every)), F.coalesce(first, F.first("head").over(every))
    seams = F.broadcast(ends.select("range_no", last.alias("seam_before"), first.alias("seam_after")))
    found = near.join(seams, "range_no").withColumn("before", F.coalesce("before", "seam_before"))
    return found.withColumn("after", F.coalesce("after", "seam_after")).drop("range_no", "seam_before", "seam_after")
