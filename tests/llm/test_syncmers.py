"""Closed syncmers and fingerprints against a plain definition."""

import hashlib
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from kitchenlight.llm import syncmers as S

SCHEMA = "doc_id long, text string, marks string, head int, text_key int"


def signed(x):
    return x - 2**64 if x >> 63 else x


def mix(*longs):
    h = 42
    for x in longs:
        h = xxhash.xxh64_intdigest(struct.pack("<q", x), h)
    return signed(h)


def plain_anchors(text):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    trimmed = (text or "").strip(" \t\n\x0b\x0c\r")
    if not words:
        return []
    if len(words) < 5:
        return [(0, signed(xxhash.xxh64_intdigest(trimmed.encode(), 42)) >> 32)]
    out = []
    for i in range(len(words) - 4):
        inner = [mix(*hashes[j : j + 2]) for j in range(i, i + 4)]  # every inner run of the k-mer
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, mix(inner[0], inner[2], inner[3]) >> 32))
    return out


def plain_sketch(text):
    marks = sorted({m for _, m in plain_anchors(text)})[:64]
    if not marks and (text or "").strip(" \t\n\x0b\x0c\r"):
        return [signed(xxhash.xxh64_intdigest(text.strip(" \t\n\x0b\x0c\r").encode(), 42)) >> 32]
    return marks


def plain_likeness(a, b):
    least = sorted(set(a) | set(b))[:64]
    return len([x for x in least if x in a and x in b]) / len(least) if least else 1.0


def texts():
    rng = random.Random(9)
    out = [None, "", " \n\t", "one", "a b c d", " a b c d e ", "w " * 9000, "x" * 60_000, "é  ü\r\nö ä ß nb ñ"]
    return out + [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 3) for _ in range(rng.randrange(400))) for _ in range(60)]


def test_anchors_and_sketches(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "i int, text string")
    found = df.select("i", S.anchors(F.col("text")).alias("a"), S.sketch(F.col("text")).alias("s")).collect()
    for r in found:
        assert [(x.position, x.mark) for x in r.a] == plain_anchors(rows[r.i][1])
        assert r.s == plain_sketch(rows[r.i][1])


def test_choice_is_context_free(spark):
    inner = "the quick brown fox jumps over the lazy dog again and again"
    df = spark.createDataFrame([(inner,), (f"p q r {inner} s t",)], "text string")
    a, b = ({(x.position, x.mark) for x in r.a} for r in df.select(S.anchors(F.col("text")).alias("a")).collect())
    assert {(p + 3, m) for p, m in a} <= b and a


def test_every_row_is_compared(spark):
    rows = [(10 * i, t, "clash", 1, 2) for i, t in enumerate(texts())]
    rows += [(40, "second text of an id here", None, None, None), (50, rows[5][1], None, None, None), (None, "no id at all", None, None, None)]
    found = S.compare_with_edits(spark.createDataFrame(rows, SCHEMA)).collect()
    distinct = sorted({(i, t or "") for i, t, *_ in rows}, key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    follow = {r: distinct[(n + 1) % len(distinct)][1] for n, r in enumerate(distinct)}
    want = Counter()
    for i, t, *_ in rows:
        t = t or ""
        after = follow[(i, t)]
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        a, b, c = plain_sketch(t), plain_sketch(edited), plain_sketch(after)
        spelled = ["".join(f"{m & 0xFFFFFFFF:08X}" for m in s) for s in (a, b)]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *spelled, plain_likeness(a, b), plain_likeness(a, c))] += 1
    assert Counter(map(tuple, found)) == want


@pytest.mark.parametrize("rows", [[], [(1, "alone in the world today", None, None, None)]])
def test_few_rows(spark, rows):
    assert S.compare_with_edits(spark.createDataFrame(rows, SCHEMA)).count() == len(rows)


def test_plan_holds_no_python(spark):
    df = S.compare_with_edits(spark.createDataFrame([(1, "a b c d e f", None, None, None)], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
