"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints of all documents are compared within buckets that share enough of their bits: with the 64 bits cut
into ``BLOCKS`` blocks, two fingerprints that differ in at most ``RADIUS`` bits agree on at least
``BLOCKS - RADIUS`` whole blocks, so every link is found in one of the tables keyed on such a choice of blocks.
Inside a bucket the bits are stored vertically, one plane per bit; one pass over the planes updates the distances
of 64 pairs per machine word in carry-save counters, and words whose pairs all exceed the radius are abandoned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import cut_lineage, id_and_text, sorted_runs
from kitchenlight.llm.components import components

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
BLOCKS = 5
TILE_ROWS = 2048

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_ONE = np.uint64(1)


# ---- fingerprints ----


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text: A-Z lower-cased, ASCII-white-space words, word shingles with repeats."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else iter([b" ".join(parts)])
    totals, done = np.zeros(64, np.int64), 0
    while done < count:  # a bounded stretch at a time, so a very long text needs little memory
        size = min(1 << 16, count - done)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, (s for s, _ in zip(shingles, range(size))), repeat(SEED)), np.uint64, size) \
            if count > 1 << 16 else np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int32)
        done += size
    return int(np.packbits(totals * 2 > count, bitorder="little").view(np.uint64)[0])


def set_fingerprint(hashes: np.ndarray) -> int:
    """64-bit SimHash of given shingle hashes: a bit is 1 if set in over half of them."""
    totals = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        totals += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(totals * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` per row; ``fp`` is the fingerprint as a signed long. Null text counts as empty (0)."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = np.fromiter(map(fingerprint, batch["text"]), np.uint64, len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": marks.view(np.int64)})

    return id_and_text(docs).mapInPandas(compute, "doc_id long, fp long")


# ---- bit-sliced comparison ----


def bit_planes(marks: np.ndarray) -> np.ndarray:
    """(64, words) array: bit ``i`` of plane ``b`` is bit ``b`` of fingerprint ``i``; padded with zeros."""
    bits = np.unpackbits(marks.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    room = np.zeros((64, (len(marks) + 63) // 64 * 8 + 8), np.uint8)
    room[:, : packed.shape[1]] = packed
    return room.view(np.uint64)


def within_radius(differing: Callable[[int, np.ndarray], np.ndarray], over: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that still hold a pair within ``radius``, and the bits of those pairs.

    ``differing(b, words)`` gives the bits of plane ``b`` that differ in the chosen words; ``over`` marks pairs that
    do not count. The counters start so that their last carry falls exactly when the radius is exceeded.
    """
    words = np.flatnonzero(over != _FULL)
    over = over[words]
    width = max(1, radius.bit_length())
    start = (1 << width) - 1 - radius
    counters = [np.full(len(words), _FULL if start >> i & 1 else 0, np.uint64) for i in range(width)]
    for plane in range(64):
        carry = differing(plane, words)
        for i, counter in enumerate(counters):
            counters[i], carry = counter ^ carry, counter & carry
        over |= carry
        if plane % 8 == 7:
            alive = over != _FULL
            if not alive.all():
                words, over, counters = words[alive], over[alive], [c[alive] for c in counters]
                if not len(words):
                    break
    return words, ~over


def _positions(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.int64)
    spread = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, column = np.nonzero(spread)
    return words[row].astype(np.int64) * 64 + column


def _mask(wanted: np.ndarray, words: int) -> np.ndarray:
    """Bits that are set where ``wanted`` is not, over whole words."""
    out = np.full(words * 8, 255, np.uint8)
    packed = np.packbits(~wanted, bitorder="little")
    out[: len(packed)] = packed
    if len(wanted) % 8:
        out[len(packed) - 1] |= (0xFF << (len(wanted) % 8)) & 0xFF
    return out.view(np.uint64)


def _lagged(marks: np.ndarray, runs: np.ndarray, lag: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs ``(i, i + lag)`` inside runs, all of them compared at once against the planes moved by ``lag``."""
    planes = bit_planes(marks)
    count = len(marks) - lag
    size = (count + 63) // 64
    far, bit = divmod(lag, 64)
    planes = np.concatenate([planes, np.zeros((64, 2), np.uint64)], axis=1)

    def differing(b: int, words: np.ndarray) -> np.ndarray:
        moved = planes[b, words + far]
        if bit:
            moved = moved >> np.uint64(bit) | planes[b, words + far + 1] << np.uint64(64 - bit)
        return planes[b, words] ^ moved

    first = _positions(*within_radius(differing, _mask(runs[:-lag] == runs[lag:], size), radius))
    return first, first + lag


def _against_all(marks: np.ndarray, radius: int, rows: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of one large bucket: blocks of rows against the bucket's planes."""
    planes = bit_planes(marks)
    size = (len(marks) + 63) // 64
    inside = np.arange(len(marks))
    for begin in range(0, len(marks), rows):
        own = marks[begin : begin + rows]
        flags = [np.where(own >> np.uint64(b) & _ONE, _FULL, np.uint64(0)) for b in range(64)]
        over = np.concatenate([_mask(inside > begin + i, size) for i in range(len(own))])

        def differing(b: int, words: np.ndarray, flags=flags) -> np.ndarray:
            return planes[b, words % size] ^ flags[b][words // size]

        words, bits = within_radius(differing, over, radius)
        at = _positions(words, bits)
        row = at // (size * 64)
        yield begin + row, at - row * size * 64


def star_edges(marks: np.ndarray, runs: np.ndarray, radius: int = RADIUS, small: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(member, root)`` that connect, within each run, exactly what links of at most ``radius`` bits connect.

    ``runs`` labels consecutive rows of one bucket. At most one edge leaves each row: links are folded into a
    union-find as they are found and never listed.
    """
    root = np.arange(len(marks))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    def fold(first: np.ndarray, second: np.ndarray) -> None:
        apart = root[first] != root[second]
        for a, b in zip(first[apart].tolist(), second[apart].tolist()):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
        if len(first):
            while (root[root] != root).any():
                root[:] = root[root]

    starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]) if len(runs) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(runs)])
    for start, size in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
        for first, second in _against_all(marks[start : start + size], radius):
            fold(first + start, second + start)
    row_sizes = np.repeat(sizes, sizes)
    for lag in range(1, int(min(small, sizes.max(initial=0)))):
        rows = np.flatnonzero((row_sizes > lag) & (row_sizes <= small))
        if len(rows):
            first, second = _lagged(marks[rows], runs[rows], lag, radius)
            fold(rows[first], rows[second])
    members = np.flatnonzero(root != np.arange(len(marks)))
    return members, root[members]


# ---- candidate buckets ----


def table_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """For each choice of ``blocks - radius`` blocks, the mask of their bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(masks, blocks - radius)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def candidate_buckets(marks: DataFrame, radius: int, blocks: int, tile_rows: int) -> DataFrame:
    """``(bucket, fp)``: every pair within the radius shares at least one bucket.

    A bucket of more than ``tile_rows`` fingerprints is dealt into tiles, and each pair of tiles becomes a bucket of
    its own; so no task holds a whole hot bucket, and no pair is left out.
    """
    keys = F.array(*(
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("k"))
        for i, mask in enumerate(table_masks(radius, blocks))
    ))
    rows = marks.select("fp", F.explode(keys).alias("key")).select(F.xxhash64("key.t", "key.k").alias("key"), "fp")
    counts = rows.groupBy("key").count().filter("count > 1")
    tiles = F.ceil(F.col("count") / tile_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    pairs: Column = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1), lambda other: F.xxhash64("key", F.least("own", other), F.greatest("own", other))
    )
    shared = rows.join(counts, "key").withColumn("tiles", tiles).withColumn("own", own)
    return shared.select(F.explode(pairs).alias("bucket"), "fp")


def _bucket_edges(radius: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in sorted_runs(batches, "bucket", 1 << 16):
            marks = np.ascontiguousarray(frame["fp"].to_numpy(np.int64)).view(np.uint64)
            member, root = star_edges(marks, frame["bucket"].to_numpy(np.int64), radius)
            yield pd.DataFrame({"u": marks[member].view(np.int64), "v": marks[root].view(np.int64)})

    return compute


def linked_fingerprints(marks: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(node, root)`` for every distinct fingerprint ``fp`` of ``marks`` that a link of at most ``radius`` bits connects to another."""
    buckets = candidate_buckets(marks, radius, blocks, tile_rows)
    edges = buckets.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_bucket_edges(radius), "u long, v long")
    return components(edges)


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most ``radius`` differing bits, the row's
    own included. Equal fingerprints are collapsed before any comparison, so thousands of exact copies cost one row;
    buckets never list pairs (see ``star_edges``). Null and empty texts have fingerprint 0 and link like any other;
    rows with a null ``doc_id`` take part, but an id is only null if a whole component has none; repeated rows each
    come back; extra columns are ignored; an empty table gives no rows.
    """
    marks = cut_lineage(fingerprints(docs))
    classes = marks.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = linked_fingerprints(classes, radius, blocks, tile_rows)
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marks.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, **settings: int) -> DataFrame:
    """One document of each group stays: the smallest ``doc_id``, of repeated ids one row. Columns are kept.

    Rows without a ``doc_id`` cannot be told apart and stay.
    """
    first = near_duplicates(docs.select("doc_id", "text"), **settings).filter("doc_id = component_id").select("doc_id").distinct()
    numbered = docs.filter("doc_id IS NOT NULL").join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return numbered.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
