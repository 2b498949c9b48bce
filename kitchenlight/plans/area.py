"""Restrict raw extracts to an area given as a seed list of ZIP codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.functions import clean, zip5

SERIAL = "SERIAL NUMBER"


def area_inspections(raw: DataFrame, seed: DataFrame) -> DataFrame:
    """Raw inspections whose ZIP is in the seed, with the code added as ``facility_zip5``.

    The seed is not hinted: Spark broadcasts it when its measured size allows.
    """
    return raw.withColumn("facility_zip5", zip5(F.col("FACILITY ZIP"))).join(
        seed.select(F.col("zip").alias("facility_zip5")), "facility_zip5", "left_semi"
    ).select(*raw.columns, "facility_zip5")


def area_violations(raw: DataFrame, kept_inspections: DataFrame) -> DataFrame:
    """Raw violations of the kept inspections, matched on the serial as written (padding included).

    Taking the serials distinct costs no shuffle of its own, as the join needs the same partitioning, and
    shrinks a serial repeated many times to one row per task. Blank serials match nothing and are left out of
    both sides before the shuffle, where they would meet in one task.
    """
    written = clean(F.col(SERIAL)) != ""
    serials = kept_inspections.filter(written).select(SERIAL).distinct()
    return raw.filter(written).join(serials, SERIAL, "left_semi").select(*raw.columns)


def zip_coverage(kept_inspections: DataFrame, violations: DataFrame) -> DataFrame:
    """Inspections and violations per ZIP.

    The violations may be the area's or all of them: the join keeps those of the kept inspections. Both
    sides are counted per serial before they meet, so a serial repeated on both never yields all its
    pairs (their number is the product of the two counts), and a hot one shrinks to a row per task.
    """
    inspections = kept_inspections.groupBy(SERIAL, "facility_zip5").agg(F.count(F.lit(1)).alias("inspection_rows"))
    per_serial = (
        violations.filter(clean(F.col(SERIAL)) != "").groupBy(SERIAL).agg(F.count(F.lit(1)).alias("violation_rows"))
    )
    per_zip = (
        inspections.join(per_serial, SERIAL)
        .groupBy(F.col("facility_zip5").alias("zip"))
        .agg(F.sum(F.col("inspection_rows") * F.col("violation_rows")).alias("violation_count"))
    )
    return (
        kept_inspections.groupBy(F.col("facility_zip5").alias("zip"))
        .agg(F.count(F.lit(1)).alias("inspection_count"))
        .join(per_zip, "zip", "full")
        .select(
            "zip",
            F.coalesce("inspection_count", F.lit(0)).alias("inspection_count"),
            F.coalesce("violation_count", F.lit(0)).alias("violation_count"),
        )
    )
