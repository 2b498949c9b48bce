"""Removal of repeated strings against a plain count of all strings."""

import random
from collections import Counter

import numpy as np
import pytest

from kitchenlight.llm import repeats as R
from kitchenlight.llm.common import scratch_path

SCHEMA = "doc_id long, text string, spans string, start int, row_no int"


def plain(texts, length):
    """(kept bytes, removed bytes, runs) of each text, from the counts of all its strings."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((kept, len(d) - len(kept), runs))
    return out


def corpus(seed, length, count=70):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice(["the ", "of ", "alpha ", "beta", "é", ". ", "zz ", "q"]) for _ in range(n))

    shared = [prose(rng.randrange(length // 4, length)) for _ in range(6)]
    out = [None, "", "short", "x" * (5 * length), "ab" * (3 * length), "abc" * (2 * length) + prose(30)]
    for _ in range(count):
        parts = [prose(rng.randrange(0, length // 2))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(shared)
            if rng.random() < 0.5:  # parts of passages, so matches end at any byte
                a, b = sorted(rng.sample(range(len(passage) + 1), 2))
                passage = passage[a:b]
            parts += [passage, prose(rng.randrange(0, length // 3))]
        out.append("".join(parts))
    whole = out[10] + prose(length)
    return [*out, whole, whole, whole[: len(whole) // 2] + "!" + whole[len(whole) // 2 :]]


def stored_rows(spark, texts):
    path = scratch_path(spark, "repeats_in")
    spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in enumerate(texts)], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("length,seed,widths", [(400, 32, (64, 8, 1)), (64, 16, (16, 1)), (40, 8, (1,))])
def test_removed_bytes_equal_a_plain_count(spark, length, seed, widths):
    texts = corpus(length, length)
    found = {r.doc_id: r for r in R.remove_repeats(stored_rows(spark, texts), length, seed, widths).collect()}
    for i, (kept, removed, runs) in enumerate(plain(texts, length)):
        r = found[i]
        assert (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) == (kept, len((texts[i] or "").encode()), removed, runs), i


def test_blocks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 700)
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abcdef ") for _ in range(size)) for size in (9000, 400, 401, 2500)]
    data = [np.frombuffer(t, np.uint8) for t in texts]
    found = [(i, at, piece) for i, d in enumerate(data) for at, piece in R.pieces_of(d, 400)]
    cells = R.first_cells([piece for _, _, piece in found])
    assert (cells["n"] == 1).all()
    low, high, anchor = R._unpack(cells["pos"])
    for i, d in enumerate(data):
        offset = np.array([at for _, at, _ in found])[cells["text"]]
        mine = np.array([n for n, _, _ in found])[cells["text"]] == i
        start, end = np.sort((low + offset)[mine]), np.sort((high + offset)[mine])
        assert start[0] == 0 and end[-1] == len(d) - 400
        assert (start[1:] == end[:-1] + 1).all()  # every string is in one cell
        assert ((low <= anchor) & (anchor + 32 <= high + 400)).all()


def test_repeats_inside_a_chunk_are_ranges_of_their_texts():
    rng = random.Random(4)
    a, b = (np.frombuffer(bytes(rng.choice(b"abcdefgh") for _ in range(600)), np.uint8) for _ in range(2))
    cells = R.first_cells([a, a, b])
    ranges = {(t, s, e) for t, s, e, n in zip(*(cells[k].tolist() for k in ("text", "pos", "core", "n"))) if n == 0}
    assert ranges == {(0, 0, 600), (1, 0, 600)}


def test_merged():
    start, end = R.merged(np.array([5, 0, 9, 20]), np.array([9, 3, 12, 21]))
    assert (start.tolist(), end.tolist()) == ([0, 5, 20], [3, 12, 21])


def test_equal_strings_have_equal_ranks():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[2000:2600] = data[100:700]
    levels = R.names(data)
    for size in (8, 9, 31, 400, 599):
        a = R._ranks(levels, np.array([100]), np.array([100 + size]))
        b = R._ranks(levels, np.array([2000, 2001]), np.array([2000 + size, 2001 + size]))
        assert a[0] == b[0] != b[1]


def test_odd_tables(spark):
    assert R.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "y" * 1000, None, None, None), (4, "only once", None, None, None), (4, None, None, None, None)]
    found = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in R.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == [(0, 1000, 1000), (4, 0, 0), (4, 9, 0)]
