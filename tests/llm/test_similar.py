"""Near copies of the pipeline against brute-force Jaccard similarity of five-word shingles."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kitchenlight.llm import similar
from kitchenlight.llm.simhash import RADIUS, set_fingerprint
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_components(rows):
    """Smallest id of each row's component by comparing every pair."""
    sets = [plain_set(t) for _, t in rows]
    low = [i for i, _ in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if root[i] != root[j] and (a == b or len(a & b) >= 0.8 * len(a | b)):
                root = [root[j] if r == root[i] else r for r in root]
    least = {r: min(low[i] for i in range(len(rows)) if root[i] == r) for r in set(root)}
    return [least[r] for r in root]


def edited(seed=3):
    rng = random.Random(seed)
    out = [None, "", " \n", "one", "One", "two words", "a b c d"]
    for n in (12, 60, 300, 300, 900):
        base = [f"w{rng.randrange(500)}" for _ in range(n)]
        for edits in range(0, 16):
            copy = list(base)
            for _ in range(edits * n // 300):
                copy[rng.randrange(n)] = f"edit{rng.randrange(9999)}"
            out.append(" ".join(copy))
    chain = [f"c{i}" for i in range(200)]
    return out + [" ".join(chain[i * 10 : i * 10 + 120]) for i in range(8)]  # each like the next, the ends not alike


def test_groups_equal_brute_force(spark):
    rows = [(i * 3 + 1, t) for i, t in enumerate(edited())]
    rows += [rows[9], rows[9]]  # repeated rows
    found = similar.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted(zip([i for i, _ in rows], plain_components(rows)))


@pytest.mark.parametrize("words,edits", [(200, 4), (400, 8), (1000, 20)])
def test_bands_find_pairs_at_the_limit(words, edits):
    rng = random.Random(words)
    for _ in range(60):
        a = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        b = list(a)
        for at in rng.sample(range(0, words, 5), edits):
            b[at] = "x" + b[at]
        one, two = similar.shingle_set(" ".join(a)), similar.shingle_set(" ".join(b))
        assert similar.similarity(one, two) >= 0.8
        assert set(similar.band_keys(one).tolist()) & set(similar.band_keys(two).tolist())


def test_the_stage_leaves_no_similar_pair(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect()]
    assert sorted(kept) == sorted(set(plain_components(rows)))


def test_rows_without_an_id_and_empty_tables(spark):
    rows = [(5, "a b c d", "en", "s", 1), (2, "a b c d", None, "s", 2), (2, "a b c d", None, "s", 2), (None, "a b c d", "en", "s", 3)]
    kept = similar.drop_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2]
    assert similar.drop_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_text_is_lost_with_a_repeated_id(spark):
    base = [f"w{i}" for i in range(300)]
    like = [*base[:299], "other"]
    rows = [(1, " ".join(base)), (2, " ".join(like)), (2, "something else entirely and nothing like it"), (2, "a third text of this id"), (3, " ".join(base))]
    for order in (rows, rows[::-1]):
        kept = similar.drop_near_copies(spark.createDataFrame([(*r, "en", "s", 1) for r in order], SCHEMA)).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == sorted([rows[0], rows[2], rows[3]])


def test_one_id_holds_a_third_of_the_rows(spark):
    rows = [(7, f"text number {i} of the common id {i * i}") for i in range(60)] + [(100 + i, f"text number {i} of the common id {i * i}") for i in range(120)]
    kept = similar.drop_near_copies(spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(rows[:60] + rows[120:])


def one_word_apart(count, words=80, seed=5):
    """Texts that each change one word of a common one: pairs that change the same word are alike to 0.88, the others to 0.77."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    return [" ".join(base[:at] + [f"new{i}"] + base[at + 1 :]) for i, at in enumerate(rng.choices(range(4, words - 4, 5), k=count))]


def test_pairs_of_a_hot_bucket_are_not_listed(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(one_word_apart(300))]
    listed = []
    linked = similar._linked

    def counted(pairs, *rest):
        listed.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(similar, "_linked", counted)
    found = similar.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(listed) <= similar.BANDS * len(rows)  # all pairs are 44,850, and meet in several buckets
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted(zip([i for i, _ in rows], plain_components(rows)))


@pytest.mark.parametrize("classes,shingles", [(7, 1 << 20), (1024, 500)])
def test_tiles_lose_no_link(spark, monkeypatch, classes, shingles):
    monkeypatch.setattr(similar, "TILE_CLASSES", classes)
    monkeypatch.setattr(similar, "TILE_SHINGLES", shingles)
    rows = [(i, t) for i, t in enumerate(one_word_apart(40) + edited())]
    found = similar.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted(zip([i for i, _ in rows], plain_components(rows)))


def test_fingerprints_meet_what_no_band_does(spark, monkeypatch):
    """The SimHash step finds candidates of its own: with bands that nothing shares, pairs within its radius are still linked."""
    rng = random.Random(4)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
        texts += [" ".join(base), " ".join(base[:-1] + ["end"])]
    marks = [set_fingerprint(similar.shingle_set(t)) for t in texts]
    near = [(a ^ b).bit_count() <= RADIUS for a, b in zip(marks[::2], marks[1::2])]
    assert sum(near) >= 6
    bands = "xxhash64(text_key, doc_id)"
    plain = similar._marks
    monkeypatch.setattr(similar, "_marks", lambda docs: plain(docs).withColumn("bands", F.expr(f"transform(bands, (b, i) -> xxhash64({bands}, i))")))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = dict(similar.near_copies(docs).select("doc_id", "component_id").collect())
    assert [found[2 * i] == found[2 * i + 1] for i in range(12)] == near
