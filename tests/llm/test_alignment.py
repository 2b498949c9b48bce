"""Token alignment against a plain walk over all byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kitchenlight.llm import alignment as A
from kitchenlight.llm.queries import QUERIES
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, links string, n_a int, pair binary"

TEXTS = [
    None, "", " ", "a", "  two  spaces  ", "line\nbreak\t tab \r\n end", "Grüße aus Köln, señor! naïve", "汉字 漢字かな 한국어", "🙂 emoji👩‍👩‍👧 x",
    "mark ▁ of the other", "<|endoftext|> is <s> plain </s> <unk> <0x41>", "zero\u0000byte", "é versus é", "x" * 3000, "word " * 500, "no-break space　wide",
    "the cat sat on the mat", "the cat sat on the mat", "http://a.b/c?d=e&f=1234567890", "﻿mark", "tab\tsep\tarated", "café cafés cafe",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def spelled(libraries, text):
    a, b = libraries
    alphabet = A.byte_alphabet()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    return ids_a, ids_b, bytes_a, bytes_b


def plain(libraries, rows):
    linked, out = [], []
    for doc_id, text in rows:
        ids_a, ids_b, bytes_a, bytes_b = spelled(libraries, text or "")
        data = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            linked.append([])
            out.append((doc_id, 0, 0, 0, 0, ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        by_end = defaultdict(list)
        for i, end in zip(ids_b, ends_b):
            by_end[end].append(i)
        linked.append([(i, j) for i, end in zip(ids_a, ends_a) for j in by_end[end]])
        groups, p, q = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            left = [str(i) for i, e in zip(ids_a, ends_a) if p < e <= end]
            groups.append(",".join(left) + "|" + ",".join(str(i) for i, e in zip(ids_b, ends_b) if p < e <= end))
            p = end
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(linked[-1]), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(link for links in linked for link in links)
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [
        (*row[:5], sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links), row[5])
        for row, links in zip(out, linked)
    ]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, b"") for i, t in rows], SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*A.COLUMNS).collect()), key=str)


@pytest.mark.parametrize("part_pairs", [A.PART_PAIRS, 37])
def test_alignment_equals_a_plain_walk(spark, libraries, part_pairs):
    rows = [*enumerate(TEXTS), (3, "a second text of one id"), (None, "the cat"), (0, "a"), (0, "a")]
    assert rows_of(A.align(frame(spark, rows), part_pairs=part_pairs)) == sorted(plain(libraries, rows), key=str)


def test_texts_that_do_not_come_back_have_no_tokens(spark):
    found = {r.doc_id: r for r in A.align(frame(spark, list(enumerate(TEXTS)))).collect()}
    assert [found[i].n_a for i in (0, 1, 9)] == [0, 0, 0] and found[9].groups_sha256 == ""
    assert found[10].n_links > 0 and found[11].n_links > 0


def test_empty_table(spark):
    found = A.align(frame(spark, []))
    assert tuple(found.columns) == A.COLUMNS and found.count() == 0


def test_windows_are_remembered_and_forgotten(monkeypatch, libraries):
    monkeypatch.setattr(A, "MEMORY_WINDOWS", 3)
    pair = A.Pair(P.path(A.BYTE_BPE), P.path(A.PIECE_BPE))
    texts = [t for t in TEXTS if t]
    together = list(A.align_texts(pair, texts))
    assert together == [found for t in texts for found in A.align_texts(pair, [t])] == list(A.align_texts(pair, texts))


def test_byte_ids_equal_the_library_of_the_vocabulary(libraries):
    pair = A.Pair(P.path(A.BYTE_BPE), P.path(A.PIECE_BPE))
    rng = random.Random(3)
    points = [c for c in range(0x11000) if not 0xD800 <= c <= 0xDFFF]
    texts = [t for t in TEXTS if t] + ["".join(f"x{chr(c)}y {chr(c)}{chr(c)} 1{chr(c)}  {chr(c)}\n" for c in points[i : i + 512]) for i in range(0, len(points), 512)]
    texts += ["".join(rng.choice([" ", "  ", "a", "the", "'s", "é", "\n", "▁", "汉", ".", "ing", "\t", "1"]) for _ in range(60)) for _ in range(400)]
    want = [f.ids for f in libraries[0].encode_batch(texts, add_special_tokens=False)]
    assert pair.bytes.encode_ordinary_batch(texts, num_threads=1) == want


def test_groups_and_links_are_the_real_output(spark, libraries):
    row = A.aligned(frame(spark, [(1, "the cats")]), groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert len(row.links) == 8 * row.n_links and row.groups.count(";") == row.n_groups - 1


def test_an_id_that_spells_nothing_is_an_error():
    with pytest.raises(ValueError, match="no byte"):
        A.Vocabulary([b"a", b""])


def test_query_equals_a_plain_walk(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows_of(QUERIES["op13_alignment"](spark, SMALL)) == sorted(plain(libraries, rows), key=str)
