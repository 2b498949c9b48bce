"""Exact continuous quantiles without one task holding all values.

``percentile`` keeps every distinct value of a group in one buffer. Here each pass counts the values of a few ranges per
cell and keeps the cells that hold the wanted ranks, until these are small enough to be ranked value by value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GRID_CELLS = 1 << 13
# Values of a cell that one task may rank. The result does not depend on it.
RANK_VALUES = 1 << 16
# A cell of the first pass holds values of one sign within a factor of four, so fewer than 2**54 doubles.
PASSES = 5


@dataclass(frozen=True)
class _Target:
    """A zero-based ``rank`` among the ``count`` values from ``low`` to ``high``."""

    rank: int
    low: float = -math.inf
    high: float = math.nan
    count: int = 0

    @property
    def settled(self) -> bool:
        return self.low == self.high or math.isnan(self.low)


def _size_class(v: Column) -> Column:
    """Cell of a double by sign and binary exponent: never falls as the value rises; NaN, the greatest, comes last."""
    size = F.floor(F.least(F.greatest(F.log2(F.abs(v)), F.lit(-1100.0)), F.lit(1100.0))).cast("int") + 2000
    return F.when(F.isnan(v), 9999).when(v == 0, 0).when(v > 0, size).otherwise(-size)


def _grid(v: Column, low: float, high: float) -> Column:
    """Cell of a value between ``low`` and ``high``, doubles of one sign: never falls as the value rises."""
    return F.floor((v - F.lit(low)) / F.lit(high - low) * GRID_CELLS).cast("int")


def _hits(cells: DataFrame, wanted: Sequence[tuple[int, int]], order: str) -> DataFrame:
    """The rows of ``cells`` (``run``, ``order``, ``n``) that hold a wanted ``(run, rank)``, with ``before``, the values ahead."""
    running = W.partitionBy("run").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = cells.withColumn("upto", F.sum("n").over(running)).withColumn("before", F.col("upto") - F.col("n"))
    held = [(F.col("run") == run) & (F.col("before") <= rank) & (F.col("upto") > rank) for run, rank in wanted]
    return placed.filter(reduce(Column.__or__, held))


def _ranges(targets: Sequence[_Target]) -> dict[tuple[float, float], int]:
    return {bounds: run for run, bounds in enumerate(dict.fromkeys((t.low, t.high) for t in targets))}


def _of_ranges(values: DataFrame, ranges: Mapping[tuple[float, float], int]) -> tuple[DataFrame, Column]:
    """The values inside the ranges, and the column that tells which; the filter is of the kind a Parquet scan takes."""
    v = F.col("v")
    inside = {run: (v >= low) & (v <= high) for (low, high), run in ranges.items()}
    number = F.coalesce(*[F.when(within, F.lit(run)) for run, within in inside.items()])
    return values.filter(reduce(Column.__or__, inside.values())), number.alias("run")


def _refined(values: DataFrame, targets: list[_Target]) -> list[_Target]:
    """Each target inside the cell of its range that holds its rank."""
    ranges = _ranges(targets)
    kept, run = _of_ranges(values, ranges)
    v = F.col("v")
    cell = F.coalesce(*[F.when((v >= low) & (v <= high), _grid(v, low, high)) for low, high in ranges]).alias("cell")
    # At most GRID_CELLS + 1 cells a range, and two ranges a quantile.
    cells = kept.groupBy(run, cell).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    wanted = [(ranges[t.low, t.high], t.rank) for t in targets]
    return _moved(_hits(cells, wanted, "cell").collect(), wanted)


def _moved(found: list, wanted: Sequence[tuple[int, int]]) -> list[_Target]:
    moved = []
    for run, rank in wanted:
        r = next(r for r in found if r.run == run and r.before <= rank < r.before + r.n)
        moved.append(_Target(rank - r.before, r.low, r.high, r.n))
    return moved


def _ranked(values: DataFrame, targets: list[_Target]) -> list[_Target]:
    """Each target settled, by ranking the distinct values of its range."""
    ranges = _ranges(targets)
    kept, run = _of_ranges(values, ranges)
    distinct = kept.groupBy(run, "v").agg(F.count(F.lit(1)).alias("n"))
    wanted = [(ranges[t.low, t.high], t.rank) for t in targets]
    found = _hits(distinct, wanted, "v").withColumns({"low": F.col("v"), "high": F.col("v")})
    return _moved(found.collect(), wanted)


def _each(targets: list[_Target], chosen: list[bool], step) -> list[_Target]:
    """``targets`` with the chosen ones put through ``step``, in place."""
    done = iter(step([t for t, now in zip(targets, chosen) if now]) if any(chosen) else [])
    return [next(done) if now else t for t, now in zip(targets, chosen)]


def exact_quantiles(df: DataFrame, value: str, fractions: Mapping[str, float]) -> DataFrame:
    """One row with a DOUBLE column per entry of ``fractions``; NULL values are ignored, NaN is the greatest value.

    Exact for any doubles: the first pass counts per sign and exponent, each further one splits the ranges still open
    into ``GRID_CELLS`` equal cells, so at most ``PASSES`` + 2 passes over the value column, two or three as a rule,
    reach single values. Of the first pass some 4,200 rows at most come to the driver, of the others two per quantile; a
    third of all rows with one value are one row per task. ``df`` is read once per pass and should be a stored table. A quantile between two values is
    interpolated linearly; without values all columns are NULL. The passes run when this is called.
    """
    values = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    # Some 4,200 classes exist, so the frame of all of them, and windows over it, are bounded.
    classes = (
        values.groupBy(F.lit(0).alias("run"), _size_class(F.col("v")).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    total = sum(r.n for r in classes)
    places = {name: q * (total - 1) for name, q in fractions.items()}
    found: dict[str, float | None] = dict.fromkeys(fractions)
    if total:
        ranks = [rank for place in places.values() for rank in (math.floor(place), math.ceil(place))]
        targets = [_in_class(sorted(classes, key=lambda r: r.cell), rank) for rank in ranks]
        for _ in range(PASSES):
            targets = _each(targets, [not t.settled and t.count > RANK_VALUES for t in targets], lambda t: _refined(values, t))
        targets = _each(targets, [not t.settled for t in targets], lambda t: _ranked(values, t))
        for number, (name, place) in enumerate(places.items()):
            lower, upper = targets[2 * number].low, targets[2 * number + 1].low
            found[name] = lower if lower == upper else lower + (upper - lower) * (place - math.floor(place))
    return df.sparkSession.range(1).select(*[F.lit(x).cast("double").alias(name) for name, x in found.items()])


def _in_class(classes: list, rank: int) -> _Target:
    """The target of a rank among all values, inside its class."""
    target = _Target(rank)
    for r in classes:
        if target.rank < r.n:
            return replace(target, low=r.low, high=r.high, count=r.n)
        target = replace(target, rank=target.rank - r.n)
    raise ValueError(f"rank {rank} is beyond the values")


def cross_one_row(*frames: DataFrame) -> DataFrame:
    """Join frames of exactly one row each into one row."""
    return reduce(lambda left, right: left.crossJoin(F.broadcast(right)), frames)
