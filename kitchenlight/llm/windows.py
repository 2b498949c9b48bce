"""Substring dedup: Rabin-Karp hashes of every window of ``WINDOW`` words, counted by Spark, merged to removal intervals.

Rows are read in homes, stretches of the input that a file and a row number name, so that both passes see the same ones
without moving a text first. A home hashes all its windows, keeps each hash once with the least id that has it, and
sends the hashes to buckets of the hash range. A bucket, which is one group of bounded size, finds the least id of every hash over all homes
and answers each home with the hashes that a smaller id elsewhere has. In the second pass a home's rows meet their answers,
and the words under repeated windows go as maximal runs. A window that a third of all documents share is one entry per home.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import id_and_text, stored

WINDOW = 13
HOME_ROWS = 1024
HOME_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
MEMORY_WORDS = 200_000
NO_ID = np.iinfo(np.int64).max

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_HALF = np.uint64(32)

BLOCKS = "home long, bucket int, hashes binary, ids binary, counts binary"
ANSWERS = "home long, hashes binary"
FOUND = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string"


# ---- windows of one home ----


class _Words(dict):
    """A word's hash; computed once while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_words = _Words()


def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each ``size`` neighbouring word hashes, its bits mixed afterwards."""
    count = max(0, len(words) - size + 1)
    out = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out *= _BASE
            out += words[i : i + count]
        out ^= out >> _HALF
        out *= _MIX
        out ^= out >> _HALF
    return out


def hashed_home(texts: list[list[bytes]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the windows of some texts, the number of the text and the first word of each; none crosses texts."""
    if len(_words) > MEMORY_WORDS:
        _words.clear()
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.concatenate([np.fromiter(map(_words.__getitem__, t), np.uint64, len(t)) for t in texts] or [np.zeros(0, np.uint64)])
    hashes = window_hashes(flat, size)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(hashes)]
    ends = np.cumsum(sizes)
    start = np.arange(len(hashes))
    inside = start + size <= ends[owner]
    return hashes[inside], owner[inside], (start - (ends - sizes)[owner])[inside]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> _HALF) * np.uint64(buckets) >> _HALF).astype(np.uint16 if buckets <= 1 << 16 else np.int64)


def home_blocks(ids: np.ndarray, texts: list[str], size: int, buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Per bucket: the distinct hashes of a home, by the least id that has each, those ids and their numbers of hashes."""
    order = np.argsort(ids, kind="stable")
    hashes, owner, _ = hashed_home([words_of(texts[i]) for i in order], size)
    first = np.sort(np.unique(hashes, return_index=True)[1])
    hashes, holder = hashes[first], ids[order][owner[first]]
    bucket = bucket_of(hashes, buckets)
    by_bucket = np.argsort(bucket, kind="stable")
    hashes, holder, bucket = hashes[by_bucket], holder[by_bucket], bucket[by_bucket]
    opens = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (holder[1:] != holder[:-1])][: len(bucket)])
    counts = np.diff(np.r_[opens, len(bucket)])
    parts = np.flatnonzero(np.r_[True, bucket[opens][1:] != bucket[opens][:-1]][: len(opens)]).tolist()
    for a, b in zip(parts, [*parts[1:], len(opens)]):
        low = opens[a]
        high = opens[b] if b < len(opens) else len(bucket)
        yield int(bucket[low]), hashes[low:high].tobytes(), holder[opens[a:b]].tobytes(), counts[a:b].astype(np.int32).tobytes()


# ---- a bucket of all homes ----


def answers(home: np.ndarray, hashes: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Per home the hashes whose least id over all homes is smaller than its own; a home's entries may come in parts."""
    order = np.argsort(hashes)
    run = hashes[order]
    same = run[1:] == run[:-1]
    shared = order[np.r_[False, same] | np.r_[same, False]]
    home, hashes, ids = home[shared], hashes[shared], ids[shared]
    order = np.lexsort((ids, home, hashes))
    home, hashes, ids = home[order], hashes[order], ids[order]
    if not len(hashes):
        return
    opens = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (home[1:] != home[:-1])])
    home, hashes, ids = home[opens], hashes[opens], ids[opens]  # one entry per hash and home, with its least id
    runs = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    least = np.repeat(np.minimum.reduceat(ids, runs), np.diff(np.r_[runs, len(hashes)]))
    home, hashes = home[ids > least], hashes[ids > least]
    order = np.argsort(home, kind="stable")
    home, hashes = home[order], hashes[order]
    cuts = np.flatnonzero(np.r_[True, home[1:] != home[:-1]][: len(home)]).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(home)]):
        yield int(home[a]), hashes[a:b].tobytes()


# ---- removal ----


def runs_under(start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of words covered by windows with these first words, which ascend; touching runs are one."""
    opens = np.flatnonzero(np.r_[True, start[1:] > start[:-1] + size][: len(start)])
    return start[opens], start[np.r_[opens[1:] - 1, len(start) - 1][: len(opens)]] + size


def removed_in_home(ids: np.ndarray, texts: list[str], elsewhere: np.ndarray, size: int) -> list[tuple]:
    """Per text, in the order given: numbers of words and removed words, removed runs, and the words kept."""
    order = np.argsort(ids, kind="stable")
    cut = [words_of(texts[i]) for i in order]
    hashes, owner, start = hashed_home(cut, size)
    values, first, group = np.unique(hashes, return_index=True, return_inverse=True)
    known = np.isin(values, elsewhere)
    ranked = ids[order]
    gone = known[group] | (ranked[owner] > ranked[owner[first]][group])
    owner, start = owner[gone], start[gone]
    edges = np.searchsorted(owner, np.arange(len(cut) + 1))
    out: list = [None] * len(cut)
    for i, words in enumerate(cut):
        begin, end = runs_under(start[edges[i] : edges[i + 1]], size)
        spans = list(zip(begin.tolist(), end.tolist()))
        marks = [0, *(p for span in spans for p in span), len(words)]
        kept = b" ".join(w for a, b in zip(marks[::2], marks[1::2]) for w in words[a:b])
        out[order[i]] = (len(words), int((end - begin).sum()), [{"start": a, "end": b} for a, b in spans], kept.decode("utf-8", "surrogatepass"))
    return out


# ---- both passes ----


def with_homes(docs: DataFrame, rows: int) -> DataFrame:
    """``(home, rank, named, text)`` of a table of files, null ids ranked last; any other table is stored first."""
    try:
        place = docs.metadataColumn("_metadata")
        home = F.xxhash64(place["file_path"], F.floor(place["row_index"] / rows))
        rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
        named = F.col("doc_id").isNotNull()
        return docs.select(home.alias("home"), rank.alias("rank"), named.alias("named"), F.coalesce("text", F.lit("")).alias("text"))
    except AnalysisException:
        return with_homes(stored(id_and_text(docs), "texts"), rows)


def remove_windows(docs: DataFrame, size: int = WINDOW, home_rows: int = HOME_ROWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, ``spans`` (maximal removed runs of words, end exclusive) and ``kept``.

    A word goes if a window of ``size`` words over it also starts in a row with a smaller doc_id. Windows are judged on the input
    and never cross rows. Rows with equal ids do not remove from one another, whatever their texts, so of repeated rows all or
    none stay; a null doc_id counts as the greatest. Null and empty texts have no words and stay empty, as do texts of
    white space; texts shorter than a window stay whole, their words joined by single spaces; very long texts are one home's
    largest arrays, 24 bytes a word; extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    total = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(F.col("text"))), F.lit(0)).alias("bytes")).first()
    rows = max(1, min(home_rows, HOME_BYTES * total["rows"] // max(1, total["bytes"])))
    buckets = 1 + total["bytes"] // bucket_bytes
    texts = with_homes(docs, rows)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for home, part in batch.groupby("home", sort=False):
                found = list(home_blocks(part["rank"].to_numpy(), part["text"].tolist(), size, buckets))
                if found:
                    yield pd.DataFrame([(home, *block) for block in found], columns=["home", "bucket", "hashes", "ids", "counts"])

    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = np.frombuffer(b"".join(frame["hashes"]), np.uint64)
        counts = np.frombuffer(b"".join(frame["counts"]), np.int32)
        ids = np.repeat(np.frombuffer(b"".join(frame["ids"]), np.int64), counts)
        home = np.repeat(frame["home"].to_numpy(), [len(h) // 8 for h in frame["hashes"]])
        return pd.DataFrame(list(answers(home, hashes, ids)), columns=["home", "hashes"])

    def remove(mine: pd.DataFrame, heard: pd.DataFrame) -> pd.DataFrame:
        elsewhere = np.frombuffer(b"".join(heard["hashes"]), np.uint64)
        found = removed_in_home(mine["rank"].to_numpy(), mine["text"].tolist(), elsewhere, size)
        out = pd.DataFrame(found, columns=["n_words", "n_removed", "spans", "kept"])
        out.insert(0, "doc_id", mine["rank"].astype("Int64").where(mine["named"]).array)
        return out

    blocks = texts.mapInPandas(send, BLOCKS)
    heard = stored(blocks.groupBy("bucket").applyInPandas(judge, ANSWERS), "answers")
    return texts.groupBy("home").cogroup(heard.groupBy("home")).applyInPandas(remove, FOUND)
