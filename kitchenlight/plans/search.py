"""Search by part of a text: a table of trigram postings beside the health mart.

Whatever holds a text of three or more letters holds all its trigrams, so the facilities on the rarest of their lists are the
only ones that can match. They are looked up first, and the ordinary search rule decides over them alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kitchenlight.sources.tables import read_table, write_table

SEARCHED = ("facility_name", "facility_address", "facility_city")
BLOCKS = 64
MOST_LISTS = 4
MOST_BROADCAST = 50_000
ZIP_MARK = "="


@dataclass(frozen=True)
class SearchIndex:
    """The mart's rows dealt into blocks by key, ``(gram, block, facility_key)``, and the length of each gram's list."""

    rows: DataFrame
    postings: DataFrame
    lengths: DataFrame


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of the lower-cased text, as the search rule lowers it; none for NULL."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    starts = F.when(F.char_length(lowered) >= 3, F.sequence(F.lit(1), F.char_length(lowered) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: lowered.substr(i, F.lit(3))))


def write_index(health: DataFrame, out: str, blocks: int = BLOCKS) -> SearchIndex:
    """Write the index of a health mart (one row per ``facility_key``) and read it back.

    Postings lie in the order of the gram, then of the key: a lookup reads the row groups of its grams, and a gram that every
    facility has is split over many tasks. A ZIP is a gram of its own, marked, since it has to be equal as a whole.
    ``blocks`` is the number of folders of the mart's copy; a search opens those of its candidates, so it should grow with the mart.
    """
    dealt = health.withColumn("block", F.pmod(F.xxhash64("facility_key"), F.lit(blocks)).cast("int"))
    dealt.repartition("block").write.mode("overwrite").partitionBy("block").parquet(f"{out}/search_rows")
    grams = F.array_distinct(F.flatten(F.array(*(trigrams(F.col(name)) for name in SEARCHED))))
    whole = F.array(F.concat(F.lit(ZIP_MARK), F.coalesce("facility_zip5", F.lit(""))))
    listed = dealt.select(F.explode(F.concat(grams, whole)).alias("gram"), "block", "facility_key").distinct()
    postings = write_table(listed, out, "search_postings", ["gram", "facility_key"])
    write_table(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("facilities")), out, "search_lengths", ["gram"])
    return read_index(health.sparkSession, out)


def read_index(spark: SparkSession, out: str) -> SearchIndex:
    return SearchIndex(*(read_table(spark, out, name) for name in ("search_rows", "search_postings", "search_lengths")))


def needed_grams(spark: SparkSession, text: str) -> list[str]:
    """The trigrams that a matching text must hold: those between the wildcards ``%`` and ``_`` of the trimmed search text."""
    pieces = F.split(F.lower(F.lit(text.strip())), "[%_]")
    row = spark.range(1).select(F.array_distinct(F.flatten(F.transform(pieces, trigrams))).alias("grams")).first()
    return sorted(row.grams)


def candidates(index: SearchIndex, text: str, most_lists: int = MOST_LISTS) -> tuple[DataFrame, int] | None:
    """``(block, facility_key)`` of all facilities that can match, and how many there are at most.

    None where the text has no run of three letters, so that every facility can match. Only the ``most_lists`` shortest lists are
    intersected: with fewer lists there are more candidates, never fewer. What is collected here is one number per gram of the text.
    """
    grams = needed_grams(index.rows.sparkSession, text)
    if not grams:
        return None
    whole = ZIP_MARK + text.strip()
    found = index.lengths.filter(F.col("gram").isin([*grams, whole])).collect()
    lengths = {row.gram: row.facilities for row in found}
    rarest = sorted(grams, key=lambda gram: (lengths.get(gram, 0), gram))[:most_lists]
    bound = lengths.get(rarest[0], 0) + lengths.get(whole, 0)
    held = F.count_if(F.col("gram").isin(rarest))
    by_zip = F.coalesce(F.bool_or(F.col("gram") == whole), F.lit(False))
    lists = index.postings.filter(F.col("gram").isin(sorted({*rarest, whole})))
    rated = lists.groupBy("block", "facility_key").agg(held.alias("held"), by_zip.alias("by_zip"))
    return rated.filter((F.col("held") == len(rarest)) | F.col("by_zip")).select("block", "facility_key"), bound


def possible_matches(index: SearchIndex, text: str, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The mart's rows that can match ``text``, to be given to the search and map queries in place of the mart.

    Up to ``most_broadcast`` candidates, as counted, are broadcast, and only their blocks of the mart are read; more are joined by
    shuffle. Texts without a run of three letters get the whole mart.
    """
    found = candidates(index, text)
    if found is None:
        return index.rows.drop("block")
    keys, bound = found
    keys = F.broadcast(keys) if bound <= most_broadcast else keys
    return index.rows.join(keys, ["block", "facility_key"], "left_semi").drop("block")
