"""Removal of repeated word windows against a plain search of all windows."""

import random

import numpy as np
import pytest

from checks.compare import differences
from kitchenlight.llm import windows as W
from kitchenlight.llm.common import scratch_path
from kitchenlight.llm.oracles import OP11_WINDOWS
from kitchenlight.llm.queries import QUERIES
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, home string, bucket int, _metadata string, hashes binary"


def plain(rows, size):
    """(words, removed words, runs, kept) of each row, from the least id that starts each window."""
    cut = [(W.NO_ID if i is None else i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in cut:
        for p in range(len(words) - size + 1):
            key = tuple(words[p : p + size])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, words in cut:
        gone = [False] * len(words)
        for p in range(len(words) - size + 1):
            if least[tuple(words[p : p + size])] < i:
                gone[p : p + size] = [True] * size
        runs = [p for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1])]
        out.append((len(words), sum(gone), len(runs), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


def corpus(seed, size, count=90):
    rng = random.Random(seed)

    def prose(n):
        return [rng.choice(["the", "of", "alpha", "beta", "é x", "zz", "q"]) for _ in range(n)]

    shared = [prose(rng.randrange(size, 3 * size)) for _ in range(5)]
    hot = prose(2 * size)
    texts = [None, "", " \t\n", "short text", "x " * (4 * size), "a b " * (2 * size)]
    for i in range(count):
        parts = prose(rng.randrange(0, size))
        for _ in range(rng.randrange(3)):
            passage = rng.choice(shared)
            a, b = sorted(rng.sample(range(len(passage) + 1), 2))
            parts += passage[a:b] + prose(rng.randrange(0, size))
        texts.append(rng.choice([" ", "\n", " \x0b "]).join(parts + (hot if i % 3 == 0 else [])))
    texts += [texts[20], texts[20], texts[21] + " more"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[10:15] = [7, 7, 7, None, None]  # repeated and missing ids, with different texts
    return list(zip(ids, texts))


def stored_rows(spark, rows, files=3):
    path = scratch_path(spark, "windows_in")
    frame = spark.createDataFrame([(i, t, "clash", 1, "clash", b"") for i, t in rows], SCHEMA)
    frame.repartition(files).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("size,home_rows,bucket_bytes", [(13, 1024, 1 << 24), (13, 4, 500), (3, 7, 2000), (1, 16, 3000)])
def test_removed_words_equal_a_plain_search(spark, size, home_rows, bucket_bytes):
    rows = corpus(size, max(size, 4))
    found = W.remove_windows(stored_rows(spark, rows), size, home_rows, bucket_bytes).collect()
    got = [(str(r.doc_id), r.n_words, r.n_removed, len(r.spans), r.kept) for r in found]
    want = [(str(i), *rest) for (i, _), rest in zip(rows, plain(rows, size))]
    assert sorted(got) == sorted(want)
    assert any(r.n_removed for r in found)
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_a_table_that_no_file_holds_is_stored_first(spark):
    rows = corpus(5, 6)
    found = W.remove_windows(spark.createDataFrame(rows, "doc_id long, text string").union(spark.createDataFrame(rows[:5], "doc_id long, text string")), 4, 8)
    want = plain(rows + rows[:5], 4)
    assert sorted((r.n_words, r.n_removed, r.kept) for r in found.collect()) == sorted((w, g, k) for w, g, _, k in want)


def test_empty_table(spark):
    found = W.remove_windows(stored_rows(spark, [], 1))
    assert found.columns == ["doc_id", "n_words", "n_removed", "spans", "kept"] and found.count() == 0


def test_one_home_in_two_parts_of_a_bucket(spark):
    home = np.array([1, 1, 2, 2], np.int64)
    hashes = np.array([9, 9, 9, 4], np.uint64)
    found = dict(W.answers(home, hashes, np.array([5, 3, 4, 1], np.int64)))
    assert {h: np.frombuffer(b, np.uint64).tolist() for h, b in found.items()} == {2: [9]}  # home 1 has the least id itself


def test_a_very_long_text(spark):
    words = [f"w{i % 5000}" for i in range(200_000)]
    rows = [(2, " ".join(words)), (1, " ".join(words[4000:4100]))]
    assert [(r.n_words, r.n_removed) for r in W.remove_windows(stored_rows(spark, rows, 1)).orderBy("doc_id").collect()] == [(100, 0), (200_000, 4000)]


def test_query_equals_its_sql(spark):
    assert differences(QUERIES["op11_windows"](spark, SMALL), SMALL, OP11_WINDOWS) == ""
