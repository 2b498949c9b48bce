"""Alignment of two tokenizers over the same bytes, by anchors at space-marked tokens.

Every text is tokenised whole by a byte-level BPE (A) and by a piece BPE with byte fallback (B). Where a space-marked token of A
and one of B begin at the same byte, both tokenisations end a token just before: these verified shared ends cut a text into windows of
token ids. Equal windows are equal pairs of id tuples, so a window's groups and links are worked out once and remembered. Link counts are
summed by Spark over all texts; they come back to the texts in parts of at most ``PART_PAIRS`` id pairs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import id_and_text, only, stored, text_slices

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
MEMORY_WINDOWS = 150_000
LONG_WINDOW = 256  # bytes of its ids
B_MARK = np.uint32(1 << 31)
PART_PAIRS = 2_000_000
SLICE_ROWS = 256
SPACE = "▁"

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


# ---- the two vocabularies ----


def byte_alphabet() -> dict[str, int]:
    """The byte of each character that a byte-level vocabulary spells bytes with: printable ones stand for themselves."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_vocabulary(path: str) -> tuple[list[bytes], dict[bytes, int]]:
    """The bytes of every id, and the ids as ranks, of a byte-level BPE whose merges are listed in the order of their ids.

    With ids as ranks another library of the same rule gives the same ids in half the time.
    """
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    vocabulary, merges = held["model"]["vocab"], held["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if held["normalizer"] or [vocabulary[x + y] for x, y in pairs] != list(range(256, 256 + len(pairs))):
        raise ValueError(f"{path} is no plain byte-level BPE with ids in the order of its merges")
    alphabet = byte_alphabet()
    plain = {bytes(map(alphabet.__getitem__, t)): i for t, i in vocabulary.items() if i < 256 + len(pairs)}
    names = {i: spelled for spelled, i in plain.items()} | {i: t.encode() for t, i in vocabulary.items() if i >= 256 + len(pairs)}
    return [names[i] for i in range(len(names))], plain


class Vocabulary:
    """The bytes of every id, their number, and whether they begin with a space."""

    def __init__(self, spelled: list[bytes]) -> None:
        self.spelled = spelled
        self.sizes = np.array([len(b) for b in spelled], np.int64)
        self.spaced = np.array([b.startswith(b" ") for b in spelled])
        if not self.sizes.all():
            raise ValueError("an id spells no byte")

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids))


class Pair:
    """Both tokenizers of a worker, their vocabularies, and the windows remembered."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        import tiktoken

        spelled, ranks = byte_vocabulary(a_path)
        self.bytes = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a = Vocabulary(spelled)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        known = range(self.pieces.get_piece_size())
        named = ((i, self.pieces.id_to_piece(i)) for i in known)
        self.b = Vocabulary([bytes([int(t[3:5], 16)]) if self.pieces.is_byte(i) else t.replace(SPACE, " ").encode() for i, t in named])
        self.shift = max(len(self.a.spelled), len(self.b.spelled))
        self.named = [f"{i}{mark}" for mark in (",", "|", ";", "\n") for i in range(self.shift)]
        self.windows: dict[bytes, tuple[str, bytes]] = {}  # by A ids, then marked B ids: groups as text, and links


def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    """One pair per worker process and files, as long as the worker aligns."""
    return only(f"pair {a_path} {b_path}", lambda: Pair(a_path, b_path))


# ---- texts ----


class Chunk:
    """Both tokenisations of some texts laid end to end, the places where both end a token, and the windows between anchors."""

    def __init__(self, pair: Pair, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        self.pair = pair
        self.a, self.b = (np.concatenate(parts or [np.zeros(0, "<u4")]) for parts in (a, b))
        size_a, size_b = pair.a.sizes[self.a], pair.b.sizes[self.b]
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        first_a, first_b = (np.cumsum([0, *(len(p) for p in parts)]) for parts in (a, b))
        open_a, open_b = pair.a.spaced[self.a], pair.b.spaced[self.b]
        open_a[first_a[:-1]] = open_b[first_b[:-1]] = True  # a text's first tokens begin together
        open_a, open_b = np.flatnonzero(open_a), np.flatnonzero(open_b)
        _, in_a, in_b = np.intersect1d((ends_a - size_a)[open_a], (ends_b - size_b)[open_b], assume_unique=True, return_indices=True)
        self.edge_a, self.edge_b = np.r_[open_a[in_a], len(self.a)], np.r_[open_b[in_b], len(self.b)]
        self.texts = np.searchsorted(self.edge_a, first_a).tolist()
        self.ends = ends_a, ends_b

    def keys(self) -> list[bytes]:
        """Per window the tuple of its A ids and its B ids, as bytes: the B ids follow, marked by their highest bit."""
        ids = np.empty(len(self.a) + len(self.b), "<u4")
        ids[np.arange(len(self.a)) + np.repeat(self.edge_b[:-1], np.diff(self.edge_a))] = self.a
        ids[np.arange(len(self.b)) + np.repeat(self.edge_a[1:], np.diff(self.edge_b))] = self.b | B_MARK
        held, edge = ids.tobytes(), (4 * (self.edge_a + self.edge_b)).tolist()
        return [held[p:q] for p, q in zip(edge, edge[1:])]

    def aligned(self, windows: np.ndarray) -> list[tuple[str, bytes]]:
        """Groups as text and the links, one a group, of some windows.

        A token spells something, so each shared end closes one group of both sides. Groups are written A tokens first; the mark after an
        id says what follows: the next id of its side, the other side, the next group, or the end of the window.
        """
        ends_a, ends_b = self.ends
        place = np.searchsorted(ends_b, ends_a)  # both reach the same end, so there is a place for each
        shut_a = np.flatnonzero(ends_b[place] == ends_a)
        shut_b = place[shut_a]
        after_a, after_b = np.r_[0, shut_a + 1], np.r_[0, shut_b + 1]  # first tokens of each group
        group_a = np.repeat(np.arange(len(shut_a)), np.diff(after_a))
        group_b = np.repeat(np.arange(len(shut_b)), np.diff(after_b))
        shift = self.pair.shift
        code_a, code_b = self.a.astype(np.int64), self.b.astype(np.int64)
        code_a[shut_a] += shift
        code_b[shut_b] += 2 * shift
        code_b[self.edge_b[1:] - 1] += shift
        codes = np.empty(len(code_a) + len(code_b), np.int64)
        codes[np.arange(len(code_a)) + after_b[group_a]] = code_a
        codes[np.arange(len(code_b)) + after_a[group_b + 1]] = code_b
        low = self.edge_a + self.edge_b
        begin, size = low[windows], low[windows + 1] - low[windows]
        chosen = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        spelled = "".join(map(self.pair.named.__getitem__, codes[chosen].tolist())).split("\n")
        links = np.column_stack([self.a[shut_a], self.b[shut_b]]).astype("<u4").tobytes()
        edge = np.searchsorted(shut_a, self.edge_a)
        first, last = edge[windows].tolist(), edge[windows + 1].tolist()
        return [(text, links[8 * p : 8 * q]) for text, p, q in zip(spelled, first, last)]


def anchored(pair: Pair, a: list[np.ndarray], b: list[np.ndarray]) -> Iterator[list[tuple[str, bytes]]]:
    """The aligned windows of each text of a chunk, whose two tokenisations spell the same bytes; those remembered are not aligned again."""
    chunk = Chunk(pair, a, b)
    keys = chunk.keys()
    found = list(map(pair.windows.get, keys))
    missing = [i for i, known in enumerate(found) if known is None]
    fresh = {keys[i]: i for i in missing}
    if fresh:
        new = dict(zip(fresh, chunk.aligned(np.fromiter(fresh.values(), np.int64, len(fresh)))))
        for i in missing:
            found[i] = new[keys[i]]
        if len(pair.windows) + len(new) > MEMORY_WINDOWS:
            pair.windows.clear()
        pair.windows.update(item for item in new.items() if len(item[0]) <= LONG_WINDOW)
    for low, high in zip(chunk.texts, chunk.texts[1:]):
        yield found[low:high]


def align_texts(pair: Pair, texts: list[str]) -> Iterator[tuple[int, int, int, str, bytes]]:
    """Per text: numbers of A tokens, B tokens and groups, the groups as text, and the links, one a group, as pairs of 32-bit ids."""
    spaced = [" " + t for t in texts]
    ids_a = [np.array(ids, "<u4") for ids in pair.bytes.encode_ordinary_batch(spaced, num_threads=1)]
    ids_b = pair.pieces.encode(texts, num_threads=1)
    whole = [i for i, t in enumerate(texts) if t and pair.b.joined(ids_b[i]) == spaced[i].encode()]  # A spells every text as it is
    windows = dict(zip(whole, anchored(pair, [ids_a[i] for i in whole], [np.array(ids_b[i], "<u4") for i in whole])))
    for i in range(len(texts)):
        if i not in windows:
            yield 0, 0, 0, "", b""
            continue
        spelled, parts = zip(*windows[i])
        links = b"".join(parts)
        yield len(ids_a[i]), len(ids_b[i]), len(links) // 8, ";".join(spelled), links


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, groups: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, ``links`` (pairs of 32-bit ids, A first) and, if asked for, ``groups``."""
    paths = a_path or public_tokenizers.path(BYTE_BPE), b_path or public_tokenizers.path(PIECE_BPE)

    kind = pa.schema([
        ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.string()), ("links", pa.binary()), *([("groups", pa.string())] if groups else []),
    ])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(*paths)
        for batch in batches:
            at = 0
            for texts in text_slices(batch, rows=SLICE_ROWS):
                n_a, n_b, n, spelled, links = zip(*align_texts(pair, texts))
                digests = [hashlib.sha256(g.encode()).hexdigest() if k else "" for g, k in zip(spelled, n_a)]
                columns = [batch.column("doc_id").slice(at, len(texts)), n_a, n_b, n, n, digests, links, *([spelled] if groups else [])]
                at += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, (list, tuple)) else c for c, t in zip(columns, kind.types)], schema=kind)
        pair.windows.clear()  # the worker goes on to other work
        pa.default_memory_pool().release_unused()

    return id_and_text(docs).mapInArrow(compute, ALIGNED + ", groups string" * groups)


# ---- counts over all texts ----


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """A few rows at a time, with the row and the id pair of each of their links; a pair is one number, the B id in its upper half."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            held = part.column("links").to_pylist()
            yield part, np.repeat(np.arange(len(held)), [len(b) // 8 for b in held]), np.frombuffer(b"".join(held), "<i8")


def pair_counts(found: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many links hold a pair of ids, and whether no pair with its B id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(None)
        for _, _, links in _sliced(batches):
            yield pa.RecordBatch.from_arrays(list(map(pa.array, np.unique(links, return_counts=True))), ["pair", "n"])

    counts = stored(found.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    counts = counts.withColumn("b", F.shiftright("pair", 32))
    return counts.join(counts.groupBy("b").agg(F.max("n").alias("most")), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _with_counts(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``found`` with the counts of one part of the pairs added to ``n_best`` and ``count_sum``."""
    part = counts.toArrow()  # at most about PART_PAIRS rows
    pair, n, best = (part[c].to_numpy() for c in ("pair", "n", "best"))
    if not len(pair):
        return found
    order = np.argsort(pair)
    held = found.sparkSession.sparkContext.broadcast((pair[order], n[order], best[order]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = held.value
        for part, row, links in _sliced(batches):
            place = np.minimum(np.searchsorted(pair, links), len(pair) - 1)
            mine = pair[place] == links
            row, place = row[mine], place[mine]
            sums = {"n_best": np.zeros(part.num_rows, np.int64), "count_sum": np.zeros(part.num_rows, np.int64)}
            np.add.at(sums["n_best"], row, best[place].astype(np.int64))
            np.add.at(sums["count_sum"], row, n[place])
            names = part.schema.names
            yield pa.RecordBatch.from_arrays([pa.array(c.to_numpy() + sums[m]) if m in sums else c for m, c in zip(names, part.columns)], names)

    return found.mapInArrow(add, found.schema)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, part_pairs: int = PART_PAIRS) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: zeros and ''. Very long texts
    are tokenised whole, each by one task. Ties for a B id's highest count are all best; repeated rows count each; a null doc_id stays
    null; extra columns are ignored; an empty table gives no rows.
    """
    found = stored(aligned(docs, a_path, b_path), "aligned")
    counts = stored(pair_counts(found), "counts")
    parts = -(-counts.count() // part_pairs)
    none = F.lit(0).cast("long")
    summed = found.withColumns({"n_best": none, "count_sum": none})
    for i in range(parts):
        summed = _with_counts(summed, counts.filter(F.pmod(F.xxhash64("pair"), F.lit(parts)) == i))
    return summed.select(*COLUMNS)
