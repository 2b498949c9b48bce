"""Benchmark decontamination: a BM25 index of the test items, searched by every passage with block-max WAND.

Items are indexed by length class (powers of two). A class is searched with passages that move on by half its
longest item and are as much longer than it, so each stretch as long as an item lies whole in some passage. Impacts are divided by the item's
own full score: a share of 1 means that the passage holds every word of the item. Retrieved items are then verified:
enough of the item's five-word shingles must be in the passage, and enough of the words of its question (all but the
last sentence) and of its answer (the last sentence).
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import id_and_text, only, text_slices

K1, B = 1.2, 0.75
LEAST_SHARE = 0.7
LEAST_OVERLAP = 0.8
SHINGLE_WORDS = 5
BLOCK_ITEMS = 16
INDEX_BYTES = 16 << 20
SCHEMA = "doc_id long, item_id long, share double, overlap double, question_overlap double, answer_overlap double"

_WORD_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words; ASCII characters other than letters and digits separate them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence is the answer; of a single sentence, its last fifth (one word at least)."""
    sentences = [w for w in map(words_of, text.replace("!", ".").replace("?", ".").split(".")) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 5)
    return words[:cut], words[cut:]


def shingles(words: list[bytes], size: int = SHINGLE_WORDS) -> set[bytes]:
    """Word shingles; of fewer words the whole sequence, of none nothing."""
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


@dataclass
class Postings:
    """One term: items in ascending order and their impacts; the greatest impact of all, and of each block of items."""

    items: list[int]
    impacts: list[float]
    most: float
    block_most: dict[int, float]


class Index:
    """Items of one length class."""

    def __init__(self, items: list[tuple[int, str]], longest: int) -> None:
        self.step = max(8, longest // 2)
        self.span = longest + self.step  # a stretch of ``longest`` words lies whole in some passage
        counts = [Counter(words_of(text)) for _, text in items]
        sizes = [sum(c.values()) for c in counts]
        mean = sum(sizes) / len(sizes)
        df = Counter(term for c in counts for term in c)
        self.ids = [item_id for item_id, _ in items]
        self.parts = [(shingles(words_of(text)), *map(set, question_and_answer(text))) for _, text in items]
        found = defaultdict(list)
        for item, (count, size) in enumerate(zip(counts, sizes)):
            score = {
                t: math.log1p((len(items) - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * size / mean))
                for t, n in count.items()
            }
            whole = math.fsum(score.values())
            for term, impact in score.items():
                found[term].append((item, impact / whole))
        self.terms = {term: i for i, term in enumerate(sorted(found))}
        self.lists = [self._postings(found[term]) for term in sorted(found)]
        self.bounds = np.array([p.most for p in self.lists] + [0.0])  # the last stands for terms no item has
        self.block_bounds = np.zeros((len(self.lists), len(items) // BLOCK_ITEMS + 1))
        for row, postings in zip(self.block_bounds, self.lists):
            np.maximum.at(row, np.array(postings.items) // BLOCK_ITEMS, postings.impacts)

    @staticmethod
    def _postings(pairs: list[tuple[int, float]]) -> Postings:
        blocks: dict[int, float] = {}
        for item, impact in pairs:
            blocks[item // BLOCK_ITEMS] = max(impact, blocks.get(item // BLOCK_ITEMS, 0.0))
        return Postings([i for i, _ in pairs], [x for _, x in pairs], max(x for _, x in pairs), blocks)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.terms.get, words, repeat(len(self.lists))), np.int64, len(words))

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All items whose share is at least ``least``, by block-max WAND over the distinct ``terms``.

        Blocks are ranges of items, the same for every list, so the bounds of all blocks are one sum of rows.
        """
        floor = least - 1e-9
        bounds = self.block_bounds.take(terms, axis=0).sum(axis=0)
        if not terms or bounds.max() < floor:
            return []
        found = []
        at = [[self.lists[t], 0] for t in terms]  # posting list, position
        for block in np.flatnonzero(bounds >= floor).tolist():
            self._advance(at, block * BLOCK_ITEMS)
            end = (block + 1) * BLOCK_ITEMS
            while True:
                here = [c for c in at if c[1] < len(c[0].items) and c[0].items[c[1]] < end]
                here.sort(key=lambda c: c[0].items[c[1]])
                total, pivot = 0.0, None
                for i, (postings, _) in enumerate(here):
                    total += postings.block_most[block]
                    if total >= floor:
                        pivot = i
                        break
                if pivot is None:
                    break
                item = here[pivot][0].items[here[pivot][1]]
                if here[0][0].items[here[0][1]] == item:
                    share = sum(c[0].impacts[c[1]] for c in here if c[0].items[c[1]] == item)
                    if share >= floor:
                        found.append((item, share))
                    self._advance(here, item + 1)
                else:
                    self._advance(here[:pivot], item)
        return found

    @staticmethod
    def _advance(cursors: list[list], item: int) -> None:
        for cursor in cursors:
            items, position = cursor[0].items, cursor[1]
            while position < len(items) and items[position] < item:
                position += 1
            cursor[1] = position

    def begins(self, count: int) -> np.ndarray:
        """Where the passages of a text begin: up to the first that reaches its end, which holds every stretch that starts later.

        A stretch of up to the longest item's words that starts in ``[begin, begin + step)`` ends within ``span`` words.
        """
        return np.arange(0, max(1, count - self.span + self.step), self.step)

    def hits(self, words: list[bytes], least: float, overlap: float) -> Iterator[tuple]:
        """Verified ``(item_id, share, shingle, question and answer overlap)`` of all passages of a text."""
        numbers = self.numbers(words)
        listed = numbers.tolist()
        begins = self.begins(len(words))
        total = np.r_[0.0, np.cumsum(self.bounds[numbers])]
        ends = np.minimum(begins + self.span, len(words))
        for i in np.flatnonzero(total[ends] - total[begins] >= least - 1e-9).tolist():
            begin, end = int(begins[i]), int(ends[i])
            own = set(listed[begin:end])
            own.discard(len(self.lists))
            found = self.search(sorted(own), least)
            if not found:
                continue
            passage = words[begin:end]
            grams, single = shingles(passage), set(passage)
            for item, share in found:
                whole, question, answer = self.parts[item]
                if len(passage) >= SHINGLE_WORDS > len(next(iter(whole)).split()):
                    grams = grams | shingles(passage, len(next(iter(whole)).split()))
                scores = [len(part & have) / max(1, len(part)) for part, have in ((whole, grams), (question, single), (answer, single))]
                if not question:
                    scores[1] = 1.0
                if min(scores) >= overlap:
                    yield self.ids[item], share, *scores


def build_indexes(items: list[tuple[int, str]]) -> list[Index]:
    classes = defaultdict(list)
    for item_id, text in items:
        if count := len(words_of(text or "")):
            classes[max(3, (count - 1).bit_length())].append((item_id, text))
    return [Index(found, max(len(words_of(text)) for _, text in found)) for _, found in sorted(classes.items())]


def text_hits(indexes: list[Index], text: str, least: float, overlap: float) -> list[tuple]:
    """The best verified passage of each item that a text holds."""
    words = words_of(text)
    best: dict[int, tuple] = {}
    for index in indexes:
        for hit in index.hits(words, least, overlap) if words else ():
            if hit[0] not in best or hit[1:] > best[hit[0]][1:]:
                best[hit[0]] = hit
    return [best[k] for k in sorted(best)]


def _shards(benchmark: DataFrame, index_bytes: int) -> Iterator[list[Index]]:
    """Indexes over parts of the items, each of about ``index_bytes`` of text at most, one after another."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL AND item_id IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / index_bytes))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).distinct().collect()
        yield build_indexes(sorted((r.item_id, r.text) for r in rows))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SHARE, overlap: float = LEAST_OVERLAP, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """A row per document and test item that some passage of the document holds.

    ``share`` is the passage's BM25 score over the item's own, at least ``least``; ``overlap`` is the part of the item's
    five-word shingles found in the passage, the other two that of the distinct words of its question and answer; all
    three are at least ``overlap``. Only an index of bounded size is broadcast:
    a benchmark of more than ``index_bytes`` is searched in parts, each over all documents. Null or empty texts and
    items give no rows; repeated documents give a row each; equal items are each reported; extra columns are ignored.
    """
    out = None
    for indexes in _shards(benchmark, index_bytes):
        held = docs.sparkSession.sparkContext.broadcast(indexes)

        def compute(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [(i, *hit) for i, t in zip(batch["doc_id"], batch["text"]) for hit in text_hits(held.value, t, least, overlap)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "share", "overlap", "question_overlap", "answer_overlap"])

        found = id_and_text(docs).mapInPandas(compute, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SHARE, overlap: float = LEAST_OVERLAP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a test item; nothing else changes and nothing is shuffled."""
    for indexes in _shards(benchmark, index_bytes):
        held = docs.sparkSession.sparkContext.broadcast(indexes)

        def compute(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            only(None)
            for batch in batches:
                clean = [not (t and text_hits(held.value, t, least, overlap)) for texts in text_slices(batch) for t in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(compute, docs.schema)
    return docs
