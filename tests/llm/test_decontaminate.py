"""Benchmark decontamination against exhaustive scoring."""

import random

import pytest

from kitchenlight.llm import decontaminate as D

DOCS = "doc_id long, text string, item_id long, share int"
ITEMS = "item_id long, text string, doc_id int"


def made(seed=2):
    rng = random.Random(seed)
    common = ["the", "of", "and", "é", "to"]
    words = common * 6 + [f"w{i}" for i in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) + (". " if rng.random() < 0.1 else "") for _ in range(n))

    items = [(i, prose(rng.randrange(5, 70)) + ".") for i in range(60)]
    docs = [prose(rng.randrange(0, 900)) for _ in range(60)]
    for k in range(30):
        words_in = items[k][1].upper().split()
        if k % 3 == 1 and len(words_in) > 30:
            words_in[3] = "edited"
        docs[k] = f"{docs[k]} {' '.join(words_in)}!! {prose(40)}"
    docs[40] = " ".join(items[41][1].split()[: len(items[41][1].split()) // 2])  # half of an item
    return items, docs


def exhaustive(index, words, least):
    """Every passage against every item by plain sums."""
    out = []
    for begin in index.begins(len(words)).tolist():
        have = set(words[begin : begin + index.span])
        for item in range(len(index.ids)):
            share = sum(p.impacts[p.items.index(item)] for t, n in index.terms.items() if t in have for p in [index.lists[n]] if item in p.items)
            if share >= least - 1e-9:
                out.append((begin, index.ids[item], round(share, 9)))
    return sorted(out)


@pytest.mark.parametrize("least", [0.25, 0.7])
def test_search_finds_every_item_above_the_threshold(least):
    items, docs = made()
    for index in D.build_indexes(items):
        for text in docs[:12] + docs[40:44]:
            words = D.words_of(text)
            got = []
            for begin in index.begins(len(words)).tolist():
                own = {index.terms[w] for w in words[begin : begin + index.span] if w in index.terms}
                got += [(begin, index.ids[i], round(s, 9)) for i, s in index.search(sorted(own), least)]
            assert sorted(got) == exhaustive(index, words, least)


def test_planted_items_are_found_and_others_are_not(spark):
    items, docs = made()
    rows = [(i, t, 1, 2) for i, t in enumerate(docs)] + [(100, None, 1, 2), (101, "", 1, 2), (102, "x " * 60_000 + items[0][1], 1, 2), (3, docs[3], 1, 2)]
    benchmark = spark.createDataFrame([(*r, 1) for r in items] + [(900, None, 1), (901, "", 1), (902, " .?", 1)], ITEMS)
    table = spark.createDataFrame(rows, DOCS)
    for index_bytes in (D.INDEX_BYTES, 3000):
        found = [(r.doc_id, r.item_id) for r in D.find_leaks(table, benchmark, index_bytes=index_bytes).collect()]
        assert {(k, k) for k in range(30)} | {(102, 0)} <= set(found)
        assert found.count((3, 3)) == 2
        assert {d for d, _ in found} <= {*range(30), 102}
    kept = D.drop_leaks(table, benchmark)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(30, 60), 100, 101])


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b c", 0, 0)], DOCS)
    assert D.find_leaks(none, items).count() == 0
    assert D.find_leaks(some, items).count() == 0
    assert D.drop_leaks(some, items).count() == 1


def test_question_and_answer():
    assert D.question_and_answer("A b c. D e? F g.") == ([b"a", b"b", b"c", b"d", b"e"], [b"f", b"g"])
    assert D.question_and_answer("one two three four five") == ([b"one", b"two", b"three", b"four"], [b"five"])
    assert D.question_and_answer("") == ([], [])


@pytest.mark.parametrize("size", range(1, 8))
def test_short_items_are_found_at_every_place(size):
    item = [f"item{i}" for i in range(size)]
    indexes = D.build_indexes([(1, " ".join(item))])
    for count in (size, 9, 16, 17, 40):
        for at in range(count - size + 1):
            words = [f"w{i}" for i in range(at)] + item + [f"w{i}" for i in range(at, count - size)]
            assert [h[0] for h in D.text_hits(indexes, " ".join(words), D.LEAST_SHARE, D.LEAST_OVERLAP)] == [1], (count, at)


def test_items_of_one_class_are_found_at_every_place():
    items = [(n, " ".join(f"i{n}x{i}" for i in range(n))) for n in (9, 12, 16, 30)]
    indexes = D.build_indexes(items)
    for item, text in items:
        for before in range(0, 60):
            padded = " ".join([f"w{i}" for i in range(before)] + text.split() + ["end"] * (before % 3))
            assert item in [h[0] for h in D.text_hits(indexes, padded, D.LEAST_SHARE, D.LEAST_OVERLAP)], (item, before)
