"""Packing of token pieces into fixed-length sequences: best fit, then a swap-based local search.

Pieces are dealt evenly into groups of bounded size. A group is packed by best fit in decreasing size; while it has
more bins than its tokens need, the local search moves single pieces, and exchanges one for one or two for one, always
raising the sum of squared fills, until bins empty. The pieces of bins that stay underfull go on to a next round with
those of the other groups.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import id_and_text, stored
from kitchenlight.llm.tokens import encoder

LENGTH = 2048
GROUP_PIECES = 8192
FULL_ENOUGH = 0.97
END_ID = 0
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---- pieces ----


def cut(count: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``count`` ids; only the first may be shorter."""
    first = (count - 1) % length + 1
    return [(0, first)] + [(at, length) for at in range(first, count, length)]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """The token pieces of every row: its ids, then the end id. Null text counts as empty."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"], encode(batch["text"].tolist())):
                ids += END_ID.to_bytes(4, "little")
                for number, (start, size) in enumerate(cut(len(ids) // 4, length)):
                    rows.append((doc_id, number, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_and_text(docs).mapInPandas(compute, PIECE_SCHEMA)


# ---- one group ----


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of positions: largest first, each into the bin it fills best. Bins are found by their gap in a bit set."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(length + 1)]
    gaps = 0  # bit g: some bin has a gap of g
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fitting = gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            number = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
            bins[number].append(i)
        else:
            gap, number = length, len(bins)
            bins.append([i])
        gap -= size
        if gap:
            by_gap[gap].append(number)
            gaps |= 1 << gap
    return bins


class LocalSearch:
    """Empties the least filled bins of a packing into the gaps of the others."""

    def __init__(self, bins: list[list[int]], sizes: list[int], length: int) -> None:
        self.bins, self.sizes, self.length = [list(b) for b in bins], sizes, length
        self.fill = [sum(sizes[i] for i in b) for b in bins]

    def run(self) -> list[list[int]]:
        needed = math.ceil(sum(self.fill) / self.length)
        tried: set[int] = set()
        while len(self.bins) - self.fill.count(0) > needed:
            left = [b for b in range(len(self.bins)) if self.fill[b] and b not in tried]
            if not left:
                break
            worst = min(left, key=self.fill.__getitem__)
            if self._empty(worst):
                tried.clear()
            else:
                tried.add(worst)
                if len(tried) >= 8:
                    break
        return [b for b in self.bins if b]

    def _empty(self, worst: int) -> bool:
        while self.bins[worst]:
            if not (self._move(worst) or self._exchange(worst)):
                return False
        return True

    def _move(self, worst: int) -> bool:
        """Move a piece into the underfull bin that it fills best, the largest piece that fits anywhere first."""
        gaps = np.array([self.length - f if f and b != worst else 0 for b, f in enumerate(self.fill)])
        for i in sorted(self.bins[worst], key=lambda i: -self.sizes[i]):
            fits = np.flatnonzero((gaps >= self.sizes[i]) & (self.length - gaps >= self.fill[worst] - self.sizes[i]))
            if len(fits):
                self._swap(worst, int(fits[np.argmin(gaps[fits])]), [i], [])
                return True
        return False

    def _exchange(self, worst: int) -> bool:
        """The exchange of one piece of ``worst`` for one or two smaller ones elsewhere that fills a gap most."""
        others = [(b, i) for b, members in enumerate(self.bins) if b != worst and 0 < self.fill[b] < self.length for i in members]
        if not others:
            return False
        bins = np.array([b for b, _ in others])
        sizes = np.array([self.sizes[i] for _, i in others])
        gaps = self.length - np.array(self.fill)[bins]
        pairs = [
            (at + x, at + y)
            for at, count in zip(*self._runs(bins)) for x in range(min(count, 24)) for y in range(x)
        ]
        first, second = (np.array(p) for p in zip(*pairs)) if pairs else (np.zeros(0, int), np.zeros(0, int))
        best = (0, -1, [], [])
        for i in self.bins[worst]:
            gain = self.sizes[i] - sizes
            gain[(gain > gaps) | (gain <= 0)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (int(gain[k]), others[k][0], [i], [others[k][1]])
            if len(first):
                gain = self.sizes[i] - sizes[first] - sizes[second]
                gain[(gain > gaps[first]) | (gain <= 0)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (int(gain[k]), others[first[k]][0], [i], [others[first[k]][1], others[second[k]][1]])
        if best[1] < 0:
            return False
        self._swap(worst, *best[1:])
        return True

    @staticmethod
    def _runs(bins: np.ndarray) -> tuple[list[int], list[int]]:
        starts = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        return starts.tolist(), np.diff(np.r_[starts, len(bins)]).tolist()

    def _swap(self, a: int, b: int, from_a: list[int], from_b: list[int]) -> None:
        for i in from_a:
            self.bins[a].remove(i)
            self.bins[b].append(i)
        for i in from_b:
            self.bins[b].remove(i)
            self.bins[a].append(i)
        moved = sum(self.sizes[i] for i in from_a) - sum(self.sizes[i] for i in from_b)
        self.fill[a] -= moved
        self.fill[b] += moved


def pack(sizes: list[int], length: int = LENGTH) -> list[list[int]]:
    bins = best_fit(sizes, length)
    return LocalSearch(bins, sizes, length).run() if len(bins) > math.ceil(sum(sizes) / length) else bins


# ---- all groups ----


def _pack_group(round_number: int, length: int, enough: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def compute(group: pd.DataFrame) -> pd.DataFrame:
        sizes = group["length"].tolist()
        sequence, offset, filled = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64), np.zeros(len(group), bool)
        base = ((round_number << 32) + int(group["deal"].iloc[0])) << 20
        for number, members in enumerate(pack(sizes, length)):
            inside = np.array([sizes[i] for i in members])
            sequence[members] = base + number
            offset[members] = np.cumsum(inside) - inside
            filled[members] = inside.sum() >= enough
        return group.drop(columns="deal").assign(sequence_id=sequence, offset=offset, filled=filled)

    return compute


def pack_pieces(found: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``found`` (a stored table of pieces of at most ``length``) with ``sequence_id`` and ``offset``.

    Rounds go on while the pieces of underfull bins need more than one group; the last round packs what is left as
    one bounded group, or, where a round left nearly as many, keeps its bins as they are.
    """
    shape = PIECE_SCHEMA + ", sequence_id long, offset long, filled boolean"
    done, left, before = [], found, math.inf
    for number in range(64):
        count = left.count()
        groups = max(1, math.ceil(count / group_pieces))
        dealt = left.withColumn("deal", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        packed = stored(dealt.groupBy("deal").applyInPandas(_pack_group(number, length, math.ceil(FULL_ENOUGH * length)), shape), "packed")
        if groups == 1 or count > 0.9 * before:
            done.append(packed)
            break
        done.append(packed.filter("filled"))
        before, left = count, packed.filter("NOT filled").drop("filled", "sequence_id", "offset")
    return reduce(DataFrame.unionByName, done).drop("filled")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Per token piece of every row: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A document's ids and the end id stay together unless they are longer than ``length``. Null and empty texts are one
    piece of one id; repeated rows are packed each; a null ``doc_id`` stays null; extra columns are ignored; an
    empty table gives no rows. Equal sizes are taken in the order of the group's rows, which changes no count.
    """
    return pack_pieces(stored(pieces(docs, tokenizer or default_tokenizer(), length), "pieces"), length, group_pieces)
