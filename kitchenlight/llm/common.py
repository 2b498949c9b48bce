"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kitchenlight.session import cut_lineage, scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators need, null text read as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def document_columns(docs: DataFrame) -> list[Column]:
    """The columns of ``documents``; those a table lacks are null."""
    kinds = {"doc_id": "long", "n_chars": "long"}
    return [
        (F.col(name) if name in docs.columns else F.lit(None)).cast(kinds.get(name, "string")).alias(name)
        for name in DOCUMENT_COLUMNS
    ]


def stored(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write once to the shared folder and read back: later stages neither recompute nor depend on executors.

    ``files`` is the number of files of a table whose rows are bounded; they are shuffled, so no scan narrows to it.
    """
    path = scratch_path(df.sparkSession, name)
    (df.repartition(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, group: str, keys: list[str], most: int, seed: int, most_groups: int = 10_000) -> DataFrame:
    """At most ``most`` rows of each group, those whose hashed ``keys`` are least; adds ``place``, their rank from 1.

    Rows of one group with equal ``keys`` count as one row, so nothing that repeats, be it an id or a text, makes the sample larger. Groups
    are counted first, and only hashes low enough to hold slightly more than ``most`` rows reach the ranking: what a
    task ranks does not grow with a group. Groups, such as languages, are few; more than ``most_groups`` are an error.
    """
    once = rows.dropDuplicates([group, *keys])
    counts = stored(once.groupBy(group).agg(F.count("*").alias("group_rows")), "groups", files=1)
    if (found := counts.count()) > most_groups:
        raise ValueError(f"{found} groups; at most {most_groups} are expected")
    mark = F.xxhash64(F.lit(seed), *keys)
    share = (most + 8 * most**0.5 + 50) / F.col("group_rows")
    near = rows.join(F.broadcast(counts), group).filter(F.shiftrightunsigned(mark, 11) / float(1 << 53) < share)
    by_mark = Window.partitionBy(group).orderBy(mark, *keys)
    near = near.drop("group_rows").dropDuplicates([group, *keys])
    return near.withColumn("place", F.row_number().over(by_mark)).filter(F.col("place") <= most)


def text_key() -> Column:
    """A hash of the text, null as empty; with the id it tells documents apart."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


def text_slices(batch, column: str = "text", rows: int = 256) -> Iterator[list[str]]:
    """The texts of an Arrow batch a few rows at a time, null ones as empty."""
    texts = batch.column(column)
    for at in range(0, len(texts), rows):
        yield [t or "" for t in texts.slice(at, rows).to_pylist()]


_held: dict[str, object] = {}


def only(key: str | None, make: Callable[[], object] | None = None) -> object:
    """The one large object a worker process keeps between tasks: ``make()`` once for ``key``; another key, or None, lets go of it.

    Workers live on from stage to stage, so what one stage needed would otherwise stay beside what the next one needs.
    """
    if key not in _held:
        if _held:
            _held.clear()
            _trim()
        if key is not None:
            _held[key] = make()
    return _held.get(key)


def _trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def sorted_runs(batches: Iterator, key: str, rows: int) -> Iterator:
    """Pandas frames of at least ``rows`` rows (the last may be smaller) that never split a run of equal ``key``."""
    import pandas as pd

    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        keys = frame[key].to_numpy()
        cut = int((keys != keys[-1]).nonzero()[0][-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut:
            yield frame.iloc[:cut]
        held, count = [frame.iloc[cut:]], len(frame) - cut
    if count:
        yield pd.concat(held, ignore_index=True)


__all__ = [
    "DOCUMENT_COLUMNS", "bounded_sample", "cut_lineage", "document_columns", "documents", "id_and_text", "only", "scratch_path", "sorted_runs", "stored",
    "text_key", "text_slices",
]
