"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from kitchenlight.llm import simhash

SCHEMA = "doc_id long, text string, lang string, fp string, u int"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, marks):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(marks[i] ^ marks[j]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, doc in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, doc), doc)
    return [least[find(i)] for i in range(len(ids))]


def texts(seed=1):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "delta", "ÉTÉ", "zeta", "eta", "THETA", "iota"]
    base = [[rng.choice(words) + str(rng.randrange(40)) for _ in range(300)] for _ in range(6)]
    out = [None, "", " \t\n", "one", "One", "two words", "a b c"]
    for b in base:
        for edits in range(12):
            copy = list(b)
            for _ in range(edits // 2):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(99))
            out.append(" ".join(copy))
    return out + ["x" * 50_000, "w " * 70_000, "w " * 70_000]


def test_fingerprint_equals_the_definition():
    for text in texts():
        assert simhash.fingerprint(text or "") == brute_fingerprint(text)


@pytest.mark.parametrize("small,size", [(64, 40), (4, 300)])
def test_star_edges_connect_what_links_connect(small, size):
    rng = np.random.default_rng(size)
    centres = rng.integers(0, 2**63, 20, dtype=np.uint64)
    marks = centres[rng.integers(0, 20, size)] ^ (np.uint64(1) << rng.integers(0, 64, size, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, size, dtype=np.uint64))
    runs = np.sort(rng.integers(0, 4, size))
    member, root = simhash.star_edges(marks, runs, small=small)
    label = np.arange(size)
    label[member] = root
    for run in range(4):
        rows = np.flatnonzero(runs == run)
        want = brute_components(rows.tolist(), [int(m) for m in marks[rows]])
        assert [int(label[i]) for i in rows] == want


def test_every_close_pair_shares_a_table():
    rng = random.Random(5)
    masks = simhash.table_masks()
    assert len(masks) == 10
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("tile_rows", [2048, 3])
def test_groups_equal_brute_force(spark, tile_rows):
    rows = [(i * 3 + 1, t, None, "clash", i) for i, t in enumerate(texts())]
    rows += [rows[9], rows[9]]  # repeated rows
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), tile_rows=tile_rows).collect()
    marks = [brute_fingerprint(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], marks, brute_components([r[0] for r in rows], marks)))
    assert sorted((r.doc_id, r.fp % 2**64, r.component_id) for r in found) == want


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d", "en", "s", 1), (2, "a b c d", None, "s", 2), (2, "a b c d", None, "s", 2), (None, "a b c d", "en", "s", 3), (9, "q w e r t y", "en", "s", 4)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "fp", "u"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 9]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert simhash.drop_near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
