"""Kneser-Ney perplexity and thresholds against a plain definition."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from kitchenlight.llm import quality as Q

DOCS = "doc_id long, text string, lang string, entropy string, limit int, keep int"
LABELS = "doc_id long, quality int, toxic int"


def plain_model(texts, table):
    """Probability of a symbol after a context by the recursive definition."""
    grams = Counter()
    for text in texts:
        row = [Q.START] * (Q.ORDER - 1) + Q.symbols_of(text, table).tolist()
        grams.update(tuple(row[i : i + Q.ORDER]) for i in range(len(row) - Q.ORDER + 1))
    counts = {Q.ORDER: grams}
    for order in range(Q.ORDER - 1, 0, -1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    less, after = {}, {}
    for order, found in counts.items():
        seen = Counter(found.values())
        d = Q.discounts(*(seen[i] for i in (1, 2, 3, 4)))
        less[order] = lambda n, d=d: d[min(n, 3) - 1]
        after[order] = defaultdict(list)
        for g, n in found.items():
            after[order][g[:-1]].append(n)

    def probability(context, symbol):
        order = len(context) + 1
        below = probability(context[1:], symbol) if order > 1 else 1 / Q.SYMBOLS
        ns = after[order].get(context)
        if not ns:
            return below
        n = counts[order].get((*context, symbol), 0)
        return (max(0, n - less[order](n)) if n else 0) / sum(ns) + sum(map(less[order], ns)) / sum(ns) * below

    return probability


def prose(rng, words=60):
    return " ".join(rng.choice(["then", "there", "other", "Hence", "été", "ho", "one"]) for _ in range(words)) + "."


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng), "en" if i % 3 else "fr", "clash", 1, 0) for i in range(240)]
    rows += [(240 + i, "".join(rng.choice("qzxQZX#%$") for _ in range(200)), "en", "clash", 1, 0) for i in range(20)]
    rows += [(300, None, "en", None, None, None), (301, "", None, None, None, None), (302, prose(rng, 20_000), "zz", None, 1, 1), (5, rows[5][1], "en", None, 1, 1)]
    labels = [(i, 1, 0) for i in range(200)] + [(i, 0, 0) for i in range(240, 250)] + [(None, 1, 0), (7, 0, 0), (9, None, None), (9, 1, 1), (11, 1, 0)]
    return rows, spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


def test_probabilities_equal_the_definition(spark, corpus):
    rows, docs, labels = corpus
    classifier = Q.Classifier(docs, labels, documents=20)
    table = classifier.held.value[0]
    sample = {r.doc_id for r in classifier.sample.collect()}
    texts = [t for i, t, *_ in rows if i in sample]
    probability = plain_model(texts, table)
    model = Q.Model(*classifier.held.value)
    others = [t for _, t, *_ in rows[:6] + rows[240:244]] + ["", "q", "the the # unseen Ωmega"]
    for text, got in zip(others, model.cross_entropies(others)):
        if not text:
            assert np.isnan(got)
            continue
        row = [Q.START] * (Q.ORDER - 1) + Q.symbols_of(text, table).tolist()
        want = -sum(math.log(probability(tuple(row[i - 4 : i]), row[i])) for i in range(4, len(row))) / len(text)
        assert got == pytest.approx(want, rel=1e-5)
    total = np.exp(model.logs[2].reshape(-1, Q.SYMBOLS).astype(float)).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-4)


@pytest.mark.parametrize("most", [0, 1, 40])
def test_contexts_that_are_not_laid_out_count_too(corpus, monkeypatch, most):
    rows, docs, labels = corpus
    held = Q.Classifier(docs, labels, documents=20).held.value
    texts = [t for _, t, *_ in rows[:6] + rows[240:244]] + ["q", "the the # unseen Ωmega"]
    want = Q.Model(*held).cross_entropies(texts)
    monkeypatch.setattr(Q, "MOST_CONTEXTS", most)
    model = Q.Model(*held)
    assert len(model.fourth) == most and len(model.rare)
    assert np.allclose(model.cross_entropies(texts), want, rtol=1e-5)


def test_a_repeated_id_is_no_larger_sample(spark):
    """One id holds a third of the rows: with one text it is one document, with many it is bounded like any others."""
    rng = random.Random(3)
    rows = [(i, prose(rng), "en", None, 1, 1) for i in range(200)]
    same = rows + [(500, "one text", "en", None, 1, 1)] * 100
    many = rows + [(500, prose(rng), "en", None, 1, 1) for _ in range(100)]
    trusted = spark.createDataFrame([(i,) for i in [*range(200), 500]], "doc_id long")
    for table in (same, many):
        docs = spark.createDataFrame(table, DOCS)
        for most in (5, 50, 10_000):
            found = Q.training_ids(docs, trusted, documents=most).collect()
            assert len(found) == len(set(found)) <= most
        assert len({r.text_key for r in found if r.doc_id == 500}) in (0, 1 if table is same else 100)


def test_all_trusted_text_counts(spark):
    """Nothing is left out of the counts but one trusted id in four, however much there is; that quarter sets the limits."""
    rng = random.Random(5)
    rows = [(i, prose(rng, 2 + i % 3), "en", None, 1, 1) for i in range(3200)] + [(4000 + i, prose(rng, 400_000), "fr", None, 1, 1) for i in range(6)]
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, 1, 0) for i, *_ in rows], LABELS)
    classifier = Q.Classifier(docs, labels)
    learned = {r.doc_id for r in classifier.sample.collect()}
    quarter = F.pmod(F.xxhash64(F.lit(41), "doc_id"), F.lit(4)) == 0
    held_out = {r.doc_id for r in docs.filter(quarter).select("doc_id").collect()}
    assert learned == {i for i, *_ in rows} - held_out and len(learned) > 2000
    assert sum(len(t) for i, t, lang, *_ in rows if i in learned and lang == "fr") > 2_000_000
    scores = spark.createDataFrame([(i, "en", i / 100) for i, *_ in rows], "doc_id long, lang string, entropy double")
    top = classifier.thresholds(scores, 1.0).first().threshold
    assert top == pytest.approx(max(held_out) / 100 + math.log(Q.MARGIN), abs=2 * Q.GRID)


@pytest.mark.parametrize("contexts", [1, 30])
def test_a_model_in_parts_gives_the_same(corpus, monkeypatch, contexts):
    rows, docs, labels = corpus
    texts = docs.select("doc_id", "text").repartition(2)
    want = {(r.doc_id, r.text): r.entropy for r in Q.Classifier(docs, labels).scored(texts).collect()}
    monkeypatch.setattr(Q, "PART_CONTEXTS", contexts)
    monkeypatch.setattr(Q, "MOST_CONTEXTS", 40)
    classifier = Q.Classifier(docs, labels)
    assert len(classifier.parts) > 2
    found = {(r.doc_id, r.text): r.entropy for r in classifier.scored(texts).collect()}
    assert found.keys() == want.keys()
    for key, entropy in found.items():
        assert entropy == want[key] if want[key] is None else entropy == pytest.approx(want[key], rel=1e-5)


def test_parts_are_bounded():
    assert Q.part_ends([]) == [Q.SYMBOLS**2]
    pairs = [(3, Q.PART_ROWS + 1, 1), (5, 10, 2), (9, Q.PART_ROWS - 10, 1), (11, 1, 1), (12, 1, Q.PART_CONTEXTS)]
    assert Q.part_ends(pairs) == [5, 11, 12, Q.SYMBOLS**2]


def test_junk_goes_and_prose_stays(corpus):
    rows, docs, labels = corpus
    found = Q.rate(docs, labels, documents=40).collect()
    assert len(found) == len(rows)
    keep = defaultdict(set)
    for r in found:
        keep[r.keep].add(r.doc_id)
    assert keep[False] == {*range(240, 260), 300, 301}
    kept = Q.keep_good(docs, labels, documents=40)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id in keep[True])


def test_sample_is_bounded_and_repeatable(corpus):
    _, docs, labels = corpus
    trusted = Q.trusted_ids(labels)
    ids = {r.doc_id for r in trusted.collect()}
    assert ids == {*range(200)} - {7, 9}
    first = sorted(r.doc_id for r in Q.training_ids(docs, trusted, documents=5).collect())
    assert first == sorted(r.doc_id for r in Q.training_ids(docs.repartition(7), trusted, documents=5).collect())
    assert len(first) == 10
    every = {r.doc_id for r in Q.training_ids(docs, trusted, documents=500).collect()}
    assert 0.6 * len(ids) < len(every) < 0.9 * len(ids)  # some are left to set the thresholds by


def test_threshold_is_the_quantile(spark, corpus):
    _, docs, labels = corpus
    classifier = Q.Classifier(docs, labels, documents=5)
    scores = spark.createDataFrame([(i, "en", 1.0 + i / 100) for i in range(200)], "doc_id long, lang string, entropy double")
    used = {r.doc_id for r in classifier.sample.collect()} | {7, 9}
    values = sorted(math.ceil(round((1.0 + i / 100) / Q.GRID, 6)) for i in range(200) if i not in used)
    want = values[math.ceil(0.9 * len(values)) - 1] * Q.GRID + math.log(Q.MARGIN)
    found = {r.lang: r.threshold for r in classifier.thresholds(scores, 0.9).collect()}
    assert found == {"en": pytest.approx(want, abs=2 * Q.GRID)}
    few = classifier.thresholds(scores.withColumn("lang", F.when(F.col("doc_id") < 20, "xx").otherwise("en")), 0.9, least=30)
    assert {r.lang for r in few.collect()} == {"en"}


def test_empty_tables(spark):
    none, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert Q.rate(none, labels).count() == 0
    some = spark.createDataFrame([(1, "text without a model", None, None, None, None)], DOCS)
    assert [r.keep for r in Q.rate(some, labels).collect()] == [True]


def test_languages_are_judged_by_their_own_trusted_text_only(spark):
    rng = random.Random(11)

    def strange():
        return " ".join(rng.choice(["żółw", "łąka", "śnieg", "źrebię", "ćma"]) for _ in range(60)) + "."

    rows = [(i, prose(rng), "en", None, 1, 1) for i in range(300)]
    rows += [(1000 + i, strange(), "rare", None, 1, 1) for i in range(20)]  # one trusted document: nothing to judge by
    rows += [(2000 + i, strange(), "few", None, 1, 1) for i in range(60)]  # some, but few held out
    rows += [(3000 + i, "".join(rng.choice("qzxQZX#%$") for _ in range(300)), "few", None, 1, 1) for i in range(5)]
    labels = [(i, 1, 0) for i in range(280)] + [(1000, 1, 0)] + [(2000 + i, 1, 0) for i in range(40)]
    found = {r.doc_id: r for r in Q.rate(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert all(found[1000 + i].keep and found[1000 + i].threshold == math.inf for i in range(20))
    assert found[2000].threshold not in (math.inf, found[0].threshold)
    assert all(found[2000 + i].keep for i in range(60))
    assert not any(found[3000 + i].keep for i in range(5))
