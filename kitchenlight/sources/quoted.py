"""CSV whose quoted fields hold line breaks, cut into records by many tasks.

A line break lies inside a field where an odd number of quotes comes before it in its file. Quotes are counted per split of
a file, and summed over the splits, so that every split knows how it begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPLIT = ("file", "split_start")


class UnclosedQuote(ValueError):
    """A file ends inside a quoted field."""


def line_order() -> Column:
    """Position of a row in its source: file, then split, then row inside the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"),
    )


def _running(lines: DataFrame, amount: Column, name: str, including: bool) -> DataFrame:
    """Add the sum of ``amount`` over the lines of a file up to each line: inside its split, plus the splits before it."""
    valued = lines.withColumn("amount", amount)
    inside = W.partitionBy(*SPLIT).orderBy("row").rowsBetween(W.unboundedPreceding, 0 if including else -1)
    # One row per split.
    ahead = W.partitionBy("file").orderBy("split_start").rowsBetween(W.unboundedPreceding, -1)
    splits = valued.groupBy(*SPLIT).agg(F.sum("amount").alias("in_split"))
    splits = splits.select(*SPLIT, F.coalesce(F.sum("in_split").over(ahead), F.lit(0)).alias("before"))
    summed = valued.withColumn("here", F.coalesce(F.sum("amount").over(inside), F.lit(0))).join(splits, list(SPLIT))
    return summed.withColumn(name, F.col("before") + F.col("here")).drop("amount", "here", "before")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files: ``line``, its quotes, and its place ``file, split_start, row``."""
    lines = spark.read.text(path, lineSep="\n").select(F.col("value").alias("line"), line_order().alias("at"))
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"')))
    return lines.select("line", quotes.cast("long").alias("quotes"), "at.*")


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files after their header line, one ``record`` a row, with the line breaks of quoted fields.

    Quotes may stand around and, doubled, inside fields only. A file that ends inside a field is an error, found before any
    record is built. Lines that are records by themselves meet no others; the lines of a broken record are grouped.
    Empty lines outside fields are skipped. A header line must not be broken.
    """
    lines = read_lines(spark, path)
    unclosed = lines.groupBy("file").agg(F.sum("quotes").alias("n")).filter(F.col("n") % 2 != 0).first()
    if unclosed is not None:
        raise UnclosedQuote(f"{unclosed.file} ends inside a quoted field")
    placed = _running(lines, F.col("quotes"), "quotes_before", including=False)
    first_row = F.min("row").over(W.partitionBy(*SPLIT))
    opens = F.col("quotes_before") % 2 == 0
    placed = placed.withColumns(
        {"opens": opens, "alone": opens & (F.col("quotes") % 2 == 0), "first_row": first_row}
    ).filter((F.col("split_start") > 0) | (F.col("row") > F.col("first_row")))
    whole = placed.filter("alone").select(F.col("line").alias("record"))
    broken = placed.filter(~F.col("alone")).select("line", "opens", "row", *SPLIT)
    numbered = _running(broken, F.col("opens").cast("long"), "number", including=True)
    parts = F.array_sort(F.collect_list(F.struct("split_start", "row", "line")))
    joined = numbered.groupBy("file", "number").agg(F.array_join(parts["line"], "\n").alias("record"))
    records = whole.unionByName(joined.select("record"))
    return records.select(F.regexp_replace("record", r"\r\z", "").alias("record")).filter(F.col("record") != "")
