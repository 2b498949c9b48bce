"""ZIP centroids from a primary source, a fallback source and hand-written overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.functions import clean, split_bar_list, unquoted
from kitchenlight.operators.audits import AuditFailure
from kitchenlight.session import cut_lineage

# Fixed value: the one override method there is.
MEAN_OF_NEIGHBOURS = "mean_neighbors"


def combine_sources(seed: DataFrame, primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Every seed code with its centroid text and ``source``; NULL where neither source has it."""
    first = primary.select("zip", F.struct("lat", "lon").alias("first"))
    second = secondary.select("zip", F.struct("lat", "lon").alias("second"))
    point = F.coalesce("first", "second")
    source = F.when(F.col("first").isNotNull(), "primary").when(F.col("second").isNotNull(), "secondary")
    return (
        seed.select("zip")
        .join(first, "zip", "left")
        .join(second, "zip", "left")
        .select("zip", point["lat"].alias("lat"), point["lon"].alias("lon"), source.alias("source"))
    )


def needed_overrides(combined: DataFrame, overrides: DataFrame) -> DataFrame:
    """Override rules for codes that still lack a centroid: ``zip, method, neighbours, line_no``.

    ``line_no`` of ``overrides`` is the order of the rules; of several rules for a code the first one counts.
    """
    rules = overrides.select(
        clean(F.col("zip")).alias("zip"),
        F.struct(
            clean(F.coalesce("method", F.lit(""))).alias("method"),
            split_bar_list(unquoted(F.coalesce("neighbors", F.lit("")))).alias("neighbours"),
            "line_no",
        ).alias("rule"),
    )
    first = rules.join(combined.filter(F.col("source").isNull()).select("zip"), "zip", "left_semi")
    return first.groupBy("zip").agg(F.min_by("rule", "rule.line_no").alias("rule")).select("zip", "rule.*")


def _with_neighbours(needed: DataFrame, placed: DataFrame, least: int | None) -> DataFrame:
    """One row per rule: ``zip, line_no, lat, lon, problem``; the means are set where there is no problem.

    A neighbour is usable when a source places it or an earlier rule does, and both its coordinates are numbers. All that a rule
    names must be usable, or, with ``least``, that many of them; one named twice counts twice.
    """
    points = placed.filter(F.col("source").isNotNull()).select(
        F.col("zip").alias("neighbour"),
        F.col("line_no").alias("made_by"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
        F.lit(True).alias("is_placed"),
    )
    known = F.col("is_placed").isNotNull() & (F.col("made_by").isNull() | (F.col("made_by") < F.col("line_no")))
    asked = F.col("neighbour").isNotNull()
    wanted = F.col("asked") if least is None else F.lit(least)
    return (
        needed.select("zip", "method", "line_no", F.explode_outer("neighbours").alias("neighbour"))
        .join(points, "neighbour", "left")
        .groupBy("zip", "method", "line_no")
        .agg(
            *[F.avg(F.when(known, F.col(name))).alias(name) for name in ("lat", "lon")],
            F.count_if(asked).alias("asked"),
            F.count_if(known).alias("known"),
            *[F.count(F.when(known, F.col(name))).alias(f"{name}_known") for name in ("lat", "lon")],
        )
        .select(
            "zip",
            "line_no",
            "lat",
            "lon",
            F.when(F.col("method") != MEAN_OF_NEIGHBOURS, "unsupported method")
            .when(F.col("asked") == 0, "no neighbours")
            .when(F.col("known") < wanted, "neighbour without centroid")
            .when(F.least("lat_known", "lon_known") < wanted, "neighbour without coordinates")
            .alias("problem"),
        )
    )


def _six_digits(value: Column) -> Column:
    # Coordinates stay below 1000, so no thousands separator can appear.
    return F.format_number(value, 6)


def _apply_once(placed: DataFrame, judged: DataFrame) -> DataFrame:
    means = judged.filter(F.col("problem").isNull()).select(
        "zip", _six_digits(F.col("lat")).alias("mean_lat"), _six_digits(F.col("lon")).alias("mean_lon"), F.col("line_no").alias("rule_no")
    )
    use = F.col("source").isNull() & F.col("rule_no").isNotNull()
    return placed.join(means, "zip", "left").select(
        "zip",
        F.when(use, F.col("mean_lat")).otherwise(F.col("lat")).alias("lat"),
        F.when(use, F.col("mean_lon")).otherwise(F.col("lon")).alias("lon"),
        F.when(use, "override").otherwise(F.col("source")).alias("source"),
        F.when(use, F.col("rule_no")).otherwise(F.col("line_no")).alias("line_no"),
    )


def resolve_overrides(combined: DataFrame, overrides: DataFrame, least: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``combined`` with the codes filled that overrides can fill, and the overrides that cannot be applied.

    A filled code gets the mean of its neighbours' centroids. The problems are rows ``zip, problem``. Both come from
    the stored sources and rules, so these are worked out once. A rule may use codes that earlier rules fill, which takes
    a round for each link of the longest such chain; without one, the usual case, there is one round.
    With ``least`` a rule needs that many usable neighbours instead of all it names.
    """
    rule_no = overrides.schema["line_no"].dataType
    placed = cut_lineage(combined.withColumn("line_no", F.lit(None).cast(rule_no)))
    needed = cut_lineage(needed_overrides(placed, overrides))
    chained = needed.select(F.explode("neighbours").alias("zip")).join(needed.select("zip"), "zip", "left_semi")
    rounds_left = 0 if chained.isEmpty() else needed.count()
    judged = cut_lineage(_with_neighbours(needed, placed, least))
    open_rules = judged.filter(F.col("problem").isNotNull()).count() if rounds_left else 0
    while rounds_left and open_rules:
        judged = cut_lineage(_with_neighbours(needed, _apply_once(placed, judged), least))
        left_open = judged.filter(F.col("problem").isNotNull()).count()
        rounds_left = 0 if left_open == open_rules else rounds_left - 1
        open_rules = left_open
    problems = judged.filter(F.col("problem").isNotNull()).select("zip", "problem")
    return _apply_once(placed, judged).drop("line_no"), problems


def apply_overrides(combined: DataFrame, overrides: DataFrame) -> DataFrame:
    """The first result of ``resolve_overrides``."""
    return resolve_overrides(combined, overrides)[0]


def override_problems(combined: DataFrame, overrides: DataFrame) -> DataFrame:
    """The second result of ``resolve_overrides``."""
    return resolve_overrides(combined, overrides)[1]


def centroid_table(resolved: DataFrame) -> DataFrame:
    """The codes with a centroid, as written to the centroid file."""
    return resolved.filter(F.col("source").isNotNull()).select("zip", "lat", "lon")


def missing_codes(resolved: DataFrame) -> DataFrame:
    """The codes no source and no override covers."""
    return resolved.filter(F.col("source").isNull()).select("zip")


def source_counts(resolved: DataFrame) -> DataFrame:
    """One row: seed codes, and how many each source gave."""
    given = {"found_from_primary": "primary", "found_from_secondary": "secondary", "found_from_overrides": "override"}
    return resolved.agg(
        F.count(F.lit(1)).alias("seed_zips"),
        *[F.count_if(F.col("source") == source).alias(name) for name, source in given.items()],
        F.count_if(F.col("source").isNull()).alias("still_missing"),
    )


def require_no_problems(problems: DataFrame) -> None:
    """Fail on override rules that cannot be applied: how many there are, and the first twenty by code."""
    count = problems.count()
    if count:
        named = "; ".join(f"{row.zip}: {row.problem}" for row in problems.orderBy("zip").limit(20).collect())
        raise AuditFailure(f"{count} overrides cannot be applied, such as {named}")
