"""Secret scan: all rules compiled into one automaton that reads every byte once; spans of the rules it reports."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kitchenlight.llm.automaton import Automaton, compile_rules, scan
from kitchenlight.llm.common import id_and_text, text_slices

SCAN_BYTES = 8 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` gives the spans; ``trigger`` is what the automaton looks for: some match of it lies wherever the
    pattern has a match long enough. ``group`` of a match has at least ``least`` characters, or it is dropped."""

    kind: str
    pattern: str
    trigger: str
    group: int = 0
    least: int = 0


# The three base rules and the length each match needs.
_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _ASSIGN + r"([A-Za-z0-9+/_.=-]+)", _ASSIGN + r"[A-Za-z0-9+/_.=-]{12}", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{14}", 0, 18),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{16}", 0, 16),
)
# Formats of public token kinds, added to the base rules.
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-[A-Za-z0-9-]"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", r"\.eyJ[A-Za-z0-9_-]"),
)
RULES = BASE_RULES + ADDED_RULES


def matches(rules: tuple[Rule, ...], hit: int, text: str) -> list[tuple[int, int, int]]:
    """``(start, rule number, end)`` of all spans of the rules whose bit is set in ``hit``, in order; code points."""
    out = []
    for number, rule in enumerate(rules):
        if hit >> number & 1:
            for m in re.finditer(rule.pattern, text, re.A):
                if len(m[rule.group]) >= rule.least:
                    out.append((m.start(), number, m.end()))
    return sorted(out)


def scan_texts(machine: Automaton, rules: tuple[Rule, ...], texts: list[str]) -> Iterator[list[tuple[int, int, int]]]:
    """The spans of each text; the automaton reads about ``SCAN_BYTES`` at a time."""
    held: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= SCAN_BYTES or i == len(texts) - 1:
            hits = scan(machine, [t.encode("utf-8", "surrogatepass") for t in held])
            yield from (matches(rules, hit, t) for hit, t in zip(hits, held))
            held, size = [], 0


def joined(rules: tuple[Rule, ...], found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{rules[number].kind}:{start}:{end}" for start, number, end in found)


def _broadcast(spark: SparkSession, rules: tuple[Rule, ...]) -> Broadcast:
    return spark.sparkContext.broadcast(compile_rules([rule.trigger for rule in rules]))  # bounded by the rules


def _per_batch(spark: SparkSession, rules: tuple[Rule, ...], make: Callable[[pd.DataFrame, list], pd.DataFrame]):
    machine = _broadcast(spark, rules)

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield make(batch, list(scan_texts(machine.value, rules, batch["text"].tolist())))

    return compute


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: ``doc_id``, ``spans`` (array of kind, start, end in code points, by start, then by rule order).

    Per kind, matches are leftmost and do not overlap; a match that is too short is dropped but still consumes its
    text. Null text counts as empty; repeated rows each come back; extra columns are ignored; no rows give no rows.
    """

    def make(batch: pd.DataFrame, found: list) -> pd.DataFrame:
        spans = [[{"kind": rules[n].kind, "start": s, "end": e} for s, n, e in one] for one in found]
        return pd.DataFrame({"doc_id": batch["doc_id"], "spans": pd.Series(spans, dtype=object, index=batch.index)})

    shape = "doc_id long, spans array<struct<kind string, start long, end long>>"
    return id_and_text(docs).mapInPandas(_per_batch(docs.sparkSession, rules, make), shape)


def digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The spans of ``find_secrets`` as counts and joined text; the same rules for nulls and ties."""
    found = find_secrets(docs, rules)

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s["start"].cast("string"), s["end"].cast("string"))), ",")

    names = [rule.kind for rule in BASE_RULES]
    base = F.filter("spans", lambda s: s.kind.isin(*names))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in names]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redact(text: str, found: list[tuple[int, int, int]], mark: str) -> str:
    """Spans replaced by ``mark``; spans that overlap are replaced as one."""
    out, at = [], 0
    for start, _, end in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if found else text


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` in ``text`` and ``n_chars`` counted anew where it is a column.

    Rows, their order of columns and null texts stay as they are.
    """
    machine = _broadcast(docs.sparkSession, rules)
    size = "n_chars" if "n_chars" in docs.columns else None

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean: list[str] = []
            for texts in text_slices(batch):
                clean += [redact(t, one, mark) for t, one in zip(texts, scan_texts(machine.value, rules, texts))]
            gone = batch.column("text").is_null().to_pylist()
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array([None if g else t for t, g in zip(clean, gone)], pa.string())
            if size:
                old = columns[size]
                sizes = [n if g else len(t) for t, g, n in zip(clean, gone, old.to_pylist())]
                columns[size] = pa.array(sizes, old.type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(compute, docs.schema)
