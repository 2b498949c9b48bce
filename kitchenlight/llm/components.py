"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import cut_lineage


EDGES_PER_PART = 500_000


def _pointed(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Point the neighbours of each ``u`` at the least of them and ``u``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    joined = pairs.join(least, "u")
    if larger_only:
        return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    moved = joined.filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(least.select("u", F.col("low").alias("v")))


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``(node, root)`` for every node that has an edge; ``root`` is the least node of its component.

    ``edges`` has the columns ``u`` and ``v`` (equal-typed, orderable); null ends, loops and repeated edges are
    ignored; an empty table gives an empty result. Every round replaces the edges by as many or fewer (large star:
    larger neighbours point at the least neighbour; small star: smaller ones do), so hubs shrink to stars; the
    least neighbour is found by a map-side minimum before any join, and a hub's rows meet one row, which the
    adaptive skew join splits. Rounds end when no edge changes; the number grows with the logarithm of the nodes.
    """
    current = cut_lineage(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    parts = 1 + current.count() // EDGES_PER_PART  # no round has more edges than the first
    parts = min(parts, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for _ in range(most_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pointed(both, larger_only=True).distinct()
        current = cut_lineage(_pointed(large, larger_only=False).distinct().coalesce(parts))
        now = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            ends = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return ends.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
