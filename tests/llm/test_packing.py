"""Tokens and packing: exact round trip, gapless sequences, counts near the least possible."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from kitchenlight.llm import packing
from kitchenlight.llm.tokens import Encoder

SCHEMA = "doc_id long, text string, piece string, offset int"


@pytest.fixture(scope="module")
def library():
    return Encoder(packing.default_tokenizer())


def odd_texts():
    rng = random.Random(4)
    out = ["", " ", "  x", " x", "x ", "x  y", "a\n b", "a \n b", "<|endoftext|> x", "it's we'll 'S", "\t x  y　z", "x\x1c y", "Ġ Ġx", "a 1234 b!? c", "x" * 3000]
    return out + ["".join(rng.choice(" \n\tab'é1!\u0085\x1d日") for _ in range(rng.randrange(60))) for _ in range(1500)]


def test_ids_equal_the_library(library):
    texts = odd_texts()
    for text, got in zip(texts * 2, library.encode(texts * 2)):
        assert np.array(library.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes() == got, repr(text)


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def fewest(sizes, length):
    """Exhaustive search for the least number of bins."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for b in {v: k for k, v in enumerate(bins)}.values():
            if bins[b] + sizes[i] <= length:
                bins[b] += sizes[i]
                place(i + 1, bins)
                bins[b] -= sizes[i]
        bins.append(sizes[i])
        place(i + 1, bins)
        bins.pop()

    place(0, [])
    return best[0]


def test_small_packings_are_near_the_least():
    rng = random.Random(8)
    extra = 0
    for _ in range(60):
        sizes = [rng.randrange(5, 70) for _ in range(11)]
        bins = packing.pack(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(11))
        assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
        extra += len(bins) - fewest(sizes, 100)
    assert extra <= 2


def test_search_improves_a_poor_start():
    rng = random.Random(1)
    sizes = [rng.randrange(100, 900) for _ in range(600)]
    start = [[i, i + 1] for i in range(0, 600, 2)]
    found = packing.LocalSearch(start, sizes, 2048).run()
    assert sorted(i for b in found for i in b) == list(range(600))
    assert all(sum(sizes[i] for i in b) <= 2048 for b in found)
    assert len(found) < 200 and max(len(b) for b in found) > 2


@pytest.mark.parametrize("group_pieces", [8192, 40])
def test_documents_are_packed_whole(spark, library, group_pieces):
    rng = random.Random(6)
    texts = [None, "", *odd_texts()[:200], *(" ".join(rng.choice(["alpha", "beta", "Γ", "42"]) for _ in range(rng.randrange(900))) for _ in range(150)), "long word " * 4000]
    rows = [(i, t, "clash", 9) for i, t in enumerate(texts)] + [(5, texts[5], None, None)] * 2 + [(None, "no id", None, None)]
    found = packing.pack_documents(spark.createDataFrame(rows, SCHEMA), group_pieces=group_pieces).collect()
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        ids = np.array([*library.library.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        for number, (start, size) in enumerate(packing.cut(len(ids) // 4)):
            want[doc_id].append((number, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)])))
    got, places = defaultdict(list), defaultdict(list)
    for r in found:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for inside in places.values():
        at = 0
        for offset, size in sorted(inside):
            assert offset == at
            at += size
        assert at <= packing.LENGTH
    total = sum(r.length for r in found)
    assert len(places) <= math.ceil(total / packing.LENGTH) + 1


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0
