"""Data-quality counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class AuditFailure(ValueError):
    """A hard check found bad rows."""


def duplicate_count(*key: str) -> Column:
    """Rows beyond the first of each key; a NULL key counts as a duplicate."""
    return F.count(F.lit(1)) - F.count_distinct(*key)


def count_checks(df: DataFrame, table: str, checks: Mapping[str, Column]) -> DataFrame:
    """Evaluate aggregate expressions in one pass: rows ``(table_name, check_name, failures)``."""
    names = list(checks)
    row = df.agg(*[checks[name].cast("long").alias(f"m{i}") for i, name in enumerate(names)])
    entries = F.array(
        *[F.struct(F.lit(name).alias("check_name"), F.col(f"m{i}").alias("failures")) for i, name in enumerate(names)]
    )
    return row.select(F.lit(table).alias("table_name"), F.inline(entries))


def union_checks(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row ``failures``: child rows whose key is not in the parent, under the NULL rule of ``NOT IN``.

    A NULL child key is not counted, and a NULL among the parent keys makes the answer zero. Child rows
    are counted and parent keys taken distinct before the join, so a hot key reaches it as one row per task.
    """
    children = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("child_rows"))
    orphans = children.join(parent.select(key).distinct(), key, "left_anti").agg(
        F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows")
    )
    null_parents = parent.agg(F.count_if(F.col(key).isNull()).alias("null_rows"))
    return orphans.crossJoin(F.broadcast(null_parents)).select(
        F.when(F.col("null_rows") > 0, 0).otherwise(F.col("orphan_rows")).cast("long").alias("failures")
    )


def require_none(table: str, failures: Mapping[str, int]) -> None:
    """Fail with the list of counted checks that found rows."""
    bad = sorted(name for name, count in failures.items() if count > 0)
    if bad:
        raise AuditFailure("; ".join(f"{table}: {name} = {failures[name]}" for name in bad))


def require_clean(checks: DataFrame) -> None:
    """Fail with the list of checks that found rows (one row per check is read)."""
    bad = checks.filter(F.col("failures") > 0).orderBy("table_name", "check_name").collect()
    if bad:
        raise AuditFailure("; ".join(f"{row.table_name}: {row.check_name} = {row.failures}" for row in bad))
