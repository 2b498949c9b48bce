"""Language identification: held-out accuracy, vectors against a plain count, odd inputs."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from kitchenlight.llm import language as L
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, score string, part int"


def test_vectors_equal_a_plain_count():
    texts = ["", "Ab, c!", "ÉÀ  \n ü", "123 ...", "x" * 3000, "日本 語", "😀 1", "a😀𐌰b"]
    chunks = list(L.count_vectors(texts))
    counts, letters = (np.concatenate([c[i] for c in chunks]) for i in (0, 1))
    for text, row, n in zip(texts, counts, letters):
        plain = "".join(c.lower() if c.isalpha() else " " for c in text)
        plain = "".join(c for i, c in enumerate(plain) if c != " " or i == 0 or plain[i - 1] != " ")
        assert n == sum(c.isalpha() for c in plain)
        want = Counter()
        for size in (1, 2, 3):
            for i in range(len(plain) - size + 1):
                want[int(L._codes(np.array([ord(c) for c in plain[i : i + size]], np.uint32), size)[0])] += 1
        assert {i: int(v) for i, v in enumerate(row) if v} == dict(want)


def test_chunks_do_not_change_vectors(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab cé") for _ in range(rng.randrange(80))) for _ in range(50)]
    whole = np.concatenate([c for c, _ in L.count_vectors(texts)])
    monkeypatch.setattr(L, "CHUNK_CHARS", 60)
    assert (np.concatenate([c for c, _ in L.count_vectors(texts)]) == whole).all()


def test_clusters_separate():
    rng = np.random.default_rng(3)
    rows = np.abs(np.repeat(np.eye(3, 20), 30, axis=0) + rng.normal(0, 0.05, (90, 20)))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centres, own = L.cluster(rows, 3)
    assert len({tuple(own[i : i + 30]) for i in (0, 30, 60)}) >= 3 and len(centres) <= 4


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: r for r in L.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in found.items() if r.held_out} == set(held)
    assert sum(found[i].lang_pred == truth[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(5)
    words = {"aa": ["alba", "bala", "laba"], "bb": ["tztz", "zuzu", "ktik"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(30)), lang, "clash", 1) for i, lang in enumerate(["aa", "bb"] * 40)]
    rows += [(900, None, "aa", None, None), (901, "", None, None, None), (902, "12 34 !?", "bb", None, None), (903, "alba " * 40_000, None, None, None), (None, "zuzu ktik", "aa", None, None), (3, rows[3][1], "bb", None, None), (904, "ωψχ ωψω", None, None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_odd_inputs(learned):
    rows, table = learned
    found = L.identify(table).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "aa", "bb"]
    assert by_id[900].score == 0 and by_id[904].rejected and not by_id[3].rejected
    assert by_id[904].lang_pred in ("aa", "bb")


def test_labels_are_no_input(spark, learned):
    rows, table = learned
    identifier = L.Identifier(table)
    bare = spark.createDataFrame([(None, r[1], None, None, None) for r in rows], SCHEMA)
    with_labels, without = (Counter((r.lang_pred, round(r.score, 5)) for r in identifier.predict(t).collect()) for t in (table, bare))
    assert with_labels == without


def test_a_repeated_id_fills_neither_sample_nor_task(spark):
    """One id holds two thirds of the rows, by one text or by many: the sample keeps its size and every language is learned."""
    own = [(i, f"alba bala {i}", "aa", None, 1) for i in range(60)] + [(100 + i, f"ktik zuzu {i}", "bb", None, 1) for i in range(40)]
    for again in ([(7001, "laba", "aa", None, 1)] * 200, [(7001, f"laba {i}", "aa", None, 1) for i in range(200)]):
        table = spark.createDataFrame(own + again, SCHEMA)
        for most in (10, 1000):
            found = Counter(r.lang for r in L.sample(table, most).collect())
            distinct = len({(r[0], r[1]) for r in own + again if r[2] == "aa" and zlib.crc32(str(r[0]).encode()) % 4 != 2})
            assert found["aa"] == min(most, distinct) and 0 < found["bb"] <= most


def test_nothing_to_learn(spark):
    assert L.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r.lang_pred for r in L.identify(spark.createDataFrame([(1, "abc", None, None, None)], SCHEMA)).collect()] == ["und"]
