"""Removal of long repeated byte strings by prefix doubling over content-chosen positions.

Every string of ``LENGTH`` bytes is filed under one of its places, its anchor: the least ``SEED_BYTES``-byte name in it, the
leftmost of equals. Equal strings have their anchors at equal offsets, so only the anchors, one in some 180 bytes, travel.
The strings of an anchor are treated together in cells of neighbouring offsets. A cell has a core, the bytes that all
its possible strings share, and a hull, the bytes that its present strings cover. Both are ranked by pairs of names
of power-of-two stretches, which are themselves built by doubling. In each round Spark sorts the ranks: a hull that
occurs again proves all its strings repeated; a core that occurs once proves all of them unique; what is left is cut into smaller cells with longer cores,
until the core is the whole string. Texts are stored once, dealt by row, so no round moves them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import scratch_path, stored

LENGTH = 400
SEED_BYTES = 32
WIDTHS = (64, 8, 1)
BLOCK = 1 << 20

_A, _B, _C = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_S29, _S32 = np.uint64(29), np.uint64(32)
_PLACE = np.uint64((1 << 22) - 1)

CELLS = "row_no long, pos long, core long, hull long, n int"


# ---- names and ranks in one text ----


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (a * _A) ^ ((b + _C) * _B)
        h ^= h >> _S29
        h *= _A
        return h ^ (h >> _S32)


def _spread(a: np.ndarray) -> np.ndarray:
    """A bijection that lets every byte reach every bit, so that pairs of its values mix well."""
    with np.errstate(over="ignore"):
        h = (a ^ (a >> _S32)) * _A
        h = (h ^ (h >> _S29)) * _B
        return h ^ (h >> _S32)


def names(data: np.ndarray) -> dict[int, np.ndarray]:
    """For stretches of 8, 16 and 32 bytes, the name of the one at every place."""
    count = len(data) - 7
    if count <= 0:
        return {}
    out = {8: _spread(np.ndarray((count,), "<u8", data, strides=(1,)).astype(np.uint64))}
    for size in (8, 16):
        if len(out[size]) > size:
            out[2 * size] = _pair(out[size][:-size], out[size][size:])
    return out


def _names_at(levels: dict[int, np.ndarray], size: int, at: np.ndarray) -> np.ndarray:
    """Names of stretches of a power of two at some places; longer ones are doubled from the two halves."""
    if size in levels:
        return levels[size][at]
    return _pair(_names_at(levels, size // 2, at), _names_at(levels, size // 2, at + size // 2))


def _ranks(levels: dict[int, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rank of each stretch ``[start, end)``: the pair of names of its first and last power-of-two stretch."""
    out = np.zeros(len(start), np.uint64)
    size = end - start
    power = 1 << (np.frexp(size.astype(float))[1] - 1)
    for p in np.unique(power).tolist():
        mine = power == p
        ends = _pair(_names_at(levels, p, start[mine]), _names_at(levels, p, end[mine] - p))
        out[mine] = _pair(ends, size[mine].astype(np.uint64))
    return out


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, size = values, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count = len(values) - width + 1
    return np.minimum(least[:count], least[width - size : width - size + count])


def _pack(low: np.ndarray, high: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return low << 18 | (high - low) << 9 | (anchor - low)


def _unpack(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = pos >> 18
    return low, low + (pos >> 9 & 511), low + (pos & 511)


def _keys(levels, length: int, width: int, low, high, anchor) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of core and hull of cells of ``width`` offsets; places are counted from where ``levels`` begin."""
    cell = (anchor - low) // width
    begin = anchor - cell * width
    core = _pair(_ranks(levels, begin, begin - width + 1 + length), cell.astype(np.uint64))
    hull = _pair(_ranks(levels, low, high + length), ((anchor - low) << 10 | (anchor - high)).astype(np.uint64))
    return core.view(np.int64), hull.view(np.int64)


def first_cells(pieces: list[np.ndarray], length: int = LENGTH, seed: int = SEED_BYTES) -> dict[str, np.ndarray]:
    """One cell per anchor of some texts: the text's number, the packed place in it, ranks, and 1 or 2 in ``n``.

    Cells that stand repeatedly in these very texts are given once, with 2, and the bytes of all of them as rows with ``n`` = 0,
    whose ``pos`` and ``core`` are start and end.
    """
    width = length - seed + 1
    data = np.concatenate(pieces)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    levels = names(data)
    seeds = levels[seed]
    places = (seeds & ~_PLACE) | np.arange(len(seeds), dtype=np.uint64)
    anchor = (_sliding_least(places, width) & _PLACE).astype(np.int64)
    start = np.flatnonzero(np.arange(len(anchor)) + length <= ends[owner[: len(anchor)]])  # strings inside one text
    anchor = anchor[start]
    opens = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    low, high, anchor = start[opens], start[np.r_[opens[1:], len(start)] - 1], anchor[opens]
    core, hull = _keys(levels, length, width, low, high, anchor)
    text = owner[low]
    base = (ends - sizes)[text]
    _, first, group, times = np.unique(_pair(core.view(np.uint64), hull.view(np.uint64)), return_index=True, return_inverse=True, return_counts=True)
    again = times[group] > 1
    # texts are kept a byte apart, so that runs of neighbours do not join
    begin, end = merged(low[again] + text[again], high[again] + length + text[again])
    inside = np.searchsorted(ends + np.arange(len(pieces)), begin, side="right")
    moved = (ends - sizes)[inside] + inside
    none = np.zeros(len(begin), np.int64)
    return {
        "text": np.r_[text[first], inside], "pos": np.r_[_pack(low - base, high - base, anchor - base)[first], begin - moved],
        "core": np.r_[core[first], end - moved], "hull": np.r_[hull[first], none], "n": np.r_[np.minimum(times, 2), none],
    }


def finer_cells(texts: list[np.ndarray], cells: list[np.ndarray], width: int, length: int = LENGTH) -> dict[str, np.ndarray]:
    """The cells of ``width`` offsets inside the given cells of some texts: the text's number, packed places and ranks."""
    sizes = np.array([len(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), [len(c) for c in cells])
    low, high, anchor = _unpack(np.concatenate(cells))
    first, last = (anchor - high) // width, (anchor - low) // width
    count = last - first + 1
    cell = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    low, high, anchor, text = (np.repeat(v, count) for v in (low, high, anchor, text))
    low, high = np.maximum(low, anchor - (cell + 1) * width + 1), np.minimum(high, anchor - cell * width)
    # only the bytes under the cells are named: they are laid end to end, and places move with them
    base = (np.cumsum(sizes) - sizes)[text]
    begin, end = merged(low + base, high + base + length)
    room = np.cumsum(end - begin) - (end - begin)
    run = np.searchsorted(begin, low + base, side="right") - 1
    group = room[run] // BLOCK
    data = np.concatenate(texts)
    out = []
    for block in np.unique(group).tolist():
        mine = group == block
        runs = np.arange(run[mine].min(), run[mine].max() + 1)
        piece = np.concatenate([data[b:e] for b, e in zip(begin[runs].tolist(), end[runs].tolist())])
        move = (base - begin[run] + room[run] - room[runs[0]])[mine]
        keys = _keys(names(piece), length, width, low[mine] + move, high[mine] + move, anchor[mine] + move)
        out.append((text[mine], _pack(low[mine], high[mine], anchor[mine]), *keys))
    return dict(zip(("text", "pos", "core", "hull"), (np.concatenate(p) for p in zip(*out))))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ``[start, end)``; touching runs are one."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    opens = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return start[opens], reach[np.r_[opens[1:] - 1, len(start) - 1]]


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


# ---- rounds over all texts ----


def _chunks(items: Iterator[tuple], size: Callable[[tuple], int]) -> Iterator[list[tuple]]:
    """Items together until they hold ``BLOCK`` bytes."""
    held, total = [], 0
    for item in items:
        held.append(item)
        total += size(item)
        if total >= BLOCK:
            yield held
            held, total = [], 0
    if held:
        yield held


def pieces_of(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """A text in pieces with their offsets; every string of ``length`` bytes starts in one of them, and none is short."""
    for at in range(0, len(data) - length + 1, BLOCK):
        yield at, data[at : at + BLOCK + length - 1]


def _first_round(length: int, seed: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = ((row, at, piece) for row, text in zip(batch["row_no"], batch["text"]) for at, piece in pieces_of(_bytes(text), length))
            for chunk in _chunks(found, lambda item: len(item[2])):
                cells = first_cells([piece for _, _, piece in chunk], length, seed)
                text = cells.pop("text")
                offset = np.array([at for _, at, _ in chunk])[text]
                cells["pos"] += np.where(cells["n"] > 0, offset << 18, offset)
                cells["core"] += np.where(cells["n"] > 0, 0, offset)
                yield pd.DataFrame({"row_no": np.array([row for row, _, _ in chunk])[text], **cells, "n": cells["n"].astype(np.int32)})

    return compute


def _finer_round(width: int, length: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["row_no"], (_bytes(t) for t in batch["text"]), (np.asarray(c, np.int64) for c in batch["cells"]))
            for chunk in _chunks(rows, lambda item: len(item[1])):
                cells = finer_cells([data for _, data, _ in chunk], [c for _, _, c in chunk], width, length)
                text = cells.pop("text")
                yield pd.DataFrame({"row_no": np.array([row for row, _, _ in chunk])[text], **cells, "n": np.ones(len(text), np.int32)})

    return compute


def _judged(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Byte ranges proved repeated, and the cells to refine.

    Equal hulls are one row from here on, however many texts share them; a core shared by different hulls is undecided,
    and one cell of each of these hulls goes on.
    """
    hulls = rows.groupBy("core", "hull").agg(F.sum("n").alias("times"), F.first("row_no").alias("row_no"), F.first("pos").alias("pos"))
    again = hulls.filter("times > 1").select("core", "hull")
    low, high = F.shiftright("pos", 18), F.shiftright("pos", 9).bitwiseAND(F.lit(511))
    proved = rows.filter("n = 1").join(again, ["core", "hull"]).select("row_no", low.alias("start"), (low + high + length).alias("end"))
    mixed = hulls.groupBy("core").agg(F.count("*").alias("hulls")).filter("hulls > 1").select("core")
    return proved, hulls.join(mixed, "core").select("row_no", "pos")


def _stored_by_row(docs: DataFrame) -> DataFrame:
    """``(row_no, doc_id, text)``, written once and bucketed by row, so that joins on ``row_no`` leave the texts in place."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = f"repeats_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, "row_no")
    dealt.write.option("compression", "zstd").option("path", scratch_path(spark, table)).bucketBy(buckets, "row_no").saveAsTable(table)
    return spark.table(table)


def with_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED_BYTES, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Every row's ``doc_id``, ``text`` and ``spans``: the byte ranges covered by repeated strings, in any order, or null.

    A string of ``length`` bytes (``2 * seed`` to 511) is repeated if it starts at two places, in the same text or in any two rows.
    """
    texts = _stored_by_row(docs)
    cells = stored(texts.select("row_no", "text").mapInPandas(_first_round(length, seed), CELLS), "cells")
    counted = cells.filter("n > 0")
    shared = counted.groupBy("core").agg(F.sum("n").alias("times")).filter("times > 1").select("core")
    proved, open_cells = _judged(stored(counted.join(shared, "core").select(*cells.columns), "shared"), length)
    ranges = [cells.filter("n = 0").select("row_no", F.col("pos").alias("start"), F.col("core").alias("end")), proved]
    for width in widths:
        by_row = open_cells.groupBy("row_no").agg(F.collect_list("pos").alias("cells"))
        finer = texts.select("row_no", "text").join(by_row, "row_no").mapInPandas(_finer_round(width, length), CELLS)
        proved, open_cells = _judged(stored(finer, "cells"), length)
        ranges.append(proved)
    spans = reduce(DataFrame.unionByName, ranges).groupBy("row_no").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return texts.join(spans, "row_no", "left").select("doc_id", "text", "spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED_BYTES, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and ``kept``, the other bytes joined.

    Texts are judged as given, not as left; matches never cross texts, but equal rows repeat one another. Null text
    counts as empty; texts shorter than ``length`` stay whole; ``kept`` need not be valid UTF-8; a null doc_id stays null;
    extra columns are ignored; an empty table gives no rows. ``docs`` should be a stored table, as rows are numbered by place.
    """

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"]):
                data = text.encode("utf-8", "surrogatepass")
                found = np.array([(s["start"], s["end"]) for s in spans] if spans is not None else [], np.int64).reshape(-1, 2)
                start, end = merged(found[:, 0], found[:, 1])
                edges = [0, *np.column_stack([start, end]).reshape(-1).tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((doc_id, len(data), len(data) - len(kept), len(start), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return with_repeats(docs, length, seed, widths).mapInPandas(compute, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
