"""The pipeline on a small sample: each stage's rows against a plain check of its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from kitchenlight.llm import decontaminate, packing, secrets, simhash
from kitchenlight.llm.common import DOCUMENT_COLUMNS, stored
from kitchenlight.llm.tokens import Encoder
from tests.conftest import SMALL
from tests.llm.test_similar import plain_components


@pytest.fixture(scope="module")
def stages(spark):
    tables = {"input": spark.read.parquet(f"{SMALL}/documents.parquet")}
    docs = tables["input"]
    for name, stage in corpus_pipeline.STAGES:
        docs = tables[name] = stored(stage(spark, docs, SMALL), name)
    return {name: table.collect() for name, table in tables.items()}


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "decontamination", "secret_scan", "packing"]


def test_columns(stages):
    for name in list(stages)[:-1]:
        assert stages[name][0].__fields__ == list(DOCUMENT_COLUMNS)


def longest_run(text):
    """How often one word stands in a row."""
    words, most, run = text.split(), 0, 0
    for before, word in zip([None, *words], words):
        run = run + 1 if word == before else 1
        most = max(most, run)
    return most


def test_quality_keeps_clean_rows_unchanged(stages, spark):
    before = {r.doc_id: r for r in stages["input"]}
    kept = stages["quality_classifier"]
    assert all(before[r.doc_id] == r for r in kept)
    kept = {r.doc_id for r in kept}
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert {i for i in before if labels.get(i) == (1, 0)} <= kept  # clean is what the labels call good
    # Unlabelled rows count as clean without marks, columns or one word over and over (such as 59, with 60 in a row).
    odd = re.compile(r"!!|%%%|\$\$\$| \||^\S+ \|$")
    plain = {i for i, r in before.items() if i not in labels and not odd.search(r.text) and longest_run(r.text) < 10}
    assert len(plain) == 95
    assert plain - kept == {64}  # its label says English, and half of its words are French
    assert len(kept) < len(before)


def test_one_document_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality_classifier"]]
    assert Counter(r.doc_id for r in stages["near_duplicates"]) == Counter(set(plain_components(rows)))


def test_no_item_is_left_and_others_stay(stages, spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in stages["decontamination"]}
    for r in stages["near_duplicates"]:
        words = b" ".join(decontaminate.words_of(r.text))
        whole = any(b" ".join(decontaminate.words_of(t)) in words for _, t in items)
        assert whole == (r.doc_id not in kept)


def test_secrets_are_gone(stages):
    before = {r.doc_id: r.text for r in stages["decontamination"]}
    every = (1 << len(secrets.RULES)) - 1
    assert len(stages["secret_scan"]) == len(before)
    for r in stages["secret_scan"]:
        assert r.text == secrets.redact(before[r.doc_id], secrets.matches(secrets.RULES, every, before[r.doc_id]), "[SECRET]")
        assert r.n_chars == len(r.text)


def test_everything_left_is_packed(stages):
    library = Encoder(packing.default_tokenizer()).library
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in stages["secret_scan"]}
    got = Counter()
    for r in stages["packing"]:
        got[r.doc_id] += r.length
    assert got == want


def test_run_gives_the_last_stage(spark, stages):
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(tuple(r[c] for c in columns) for r in found) == sorted(tuple(r[c] for c in columns) for r in stages["packing"])


def test_simhash_settings_are_the_contract():
    assert (simhash.RADIUS, simhash.SHINGLE_WORDS, simhash.SEED) == (3, 3, 42)
