"""Secret scan against plain regular expressions."""

import hashlib
import random
import re

import pytest

from kitchenlight.llm import automaton, secrets

SCHEMA = "doc_id long, text string, spans string, n_chars long, null_text int"


def brute(text):
    rules = [
        ("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
    ]
    out = []
    for order, (kind, rule, group, least) in enumerate(rules):
        out += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in rule.finditer(text) if len(m[group]) >= least]
    return [s for _, _, s in sorted(out)]


PARTS = ["token", "TOKEN", "api_key", "apikey", "passwd", "password", "ſecret", "secret", "=", ":", " ", "  ", '"', "'", "AKIA", "ABCD1234", "deadbeef", "0123456789abcdef", "Zz+/_.=-", "é", "\n", "x", "ghp_" + "a1B2" * 9, "eyJ" + "a" * 12 + ".", "-----BEGIN RSA PRIVATE KEY-----", "#", "AKIAAKIA"]


def texts(count=400):
    rng = random.Random(3)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 40))) for _ in range(count)]
    return [None, "", *made, "a" * 100_000, "token=" * 20_000, "g" * 3000 + "AKIA" + "Q" * 14 + "g" * 3000]


@pytest.fixture(scope="module")
def machine():
    return automaton.compile_rules([r.trigger for r in secrets.RULES])


def test_automaton_reports_every_rule_that_matches(machine):
    data = [(t or "").encode() for t in texts()]
    want = [sum(1 << i for i, r in enumerate(secrets.RULES) if re.search(r.trigger.encode(), t)) for t in data]
    assert automaton.scan(machine, data) == want
    assert automaton.scan(machine, data, stretch=1) == want


def test_automaton_is_minimal():
    machine = automaton.compile_rules(["a(b|c)d", "abd|acd"])
    assert machine.step.shape[0] == 4  # nothing, a, a[bc], a[bc]d


def test_digest_equals_plain_search(spark):
    rows = [(i, t, "clash", 1, i) for i, t in enumerate(texts())] + [(7, "token=abcdefghijklmnop", None, None, None)] * 2
    found = {r.doc_id: r for r in secrets.digest(spark.createDataFrame(rows, SCHEMA)).collect() if r.doc_id != 7}
    for doc_id, text, *_ in rows:
        if doc_id == 7:
            continue
        base = brute(text or "")
        row = found[doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex"))
        assert [s for s in row.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")] == base
    assert secrets.digest(spark.createDataFrame(rows, SCHEMA)).count() == len(rows)
    assert secrets.digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_redaction(spark):
    rows = [(1, 'x token = "abcdefabcdefabcdefabcdef" y', "s", 5, 1), (2, None, None, 7, None), (3, "plain", "s", 99, 2)]
    out = secrets.redact_secrets(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "spans", "n_chars", "null_text"]
    assert sorted(map(tuple, out.collect())) == [(1, 'x [SECRET]" y', "s", 13, 1), (2, None, None, 7, None), (3, "plain", "s", 5, 2)]
