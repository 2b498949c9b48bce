"""Language identification by the nearest of several centroids per language.

A text is a vector of weighted character n-gram counts (one to three letters, hashed, logarithmic counts times inverse
document frequencies), normalised. Each language has a few centroids, clustered from a bounded sample of labelled documents;
the nearest by cosine gives the language, and a text further away than the centroid's own documents are is marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import bounded_sample, stored, text_key

DIMENSIONS = 4096
SAMPLE_DOCUMENTS = 1500
CLUSTERS = 4
ROUNDS = 12
REACH_QUANTILE = 0.995
REACH_MARGIN = 1.25
MOST_CENTROIDS = 4000
CHUNK_CHARS = 1 << 20
CHUNK_TEXTS = 256
UNKNOWN = "und"

_LETTERS = np.array([ord(chr(c).lower()) if chr(c).isalpha() and len(chr(c).lower()) == 1 else c if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint32)


# ---- vectors ----


def _codes(points: np.ndarray, length: int) -> np.ndarray:
    """A hash below ``DIMENSIONS`` of each run of ``length`` letters or spaces."""
    with np.errstate(over="ignore"):
        code = np.full(len(points) - length + 1, np.uint32(length * 0x9E3779B1 & 0xFFFFFFFF), np.uint32)
        for i in range(length):
            code = (code ^ points[i : len(points) - length + 1 + i]) * np.uint32(0x85EBCA6B)
            code ^= code >> np.uint32(13)
        return (code * np.uint32(0xC2B2AE35)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)


def _chunk_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    points = np.concatenate(raw) if raw else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(r) for r in raw])
    beyond = points >= len(_LETTERS)
    points = np.where(beyond, points, _LETTERS[np.minimum(points, len(_LETTERS) - 1)])
    for point in np.unique(points[beyond]).tolist():  # letters beyond the table keep their code point
        if not chr(point).isalpha():
            points[points == point] = 32
    letter = points != 32
    letters = np.bincount(owner[letter], minlength=len(texts))
    keep = letter.copy()
    keep[:1] = True
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])  # of a run of other characters, the first is kept as a space
    points, owner = points[keep], owner[keep]
    counts = np.zeros(len(texts) * DIMENSIONS, np.int64)
    for length in (1, 2, 3):
        if len(points) >= length:
            whole = owner[: len(owner) - length + 1] == owner[length - 1 :]
            at = owner[: len(whole)] * DIMENSIONS + _codes(points, length)
            counts += np.bincount(at[whole], minlength=len(counts))
    return counts.reshape(len(texts), DIMENSIONS), letters


def count_vectors(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of n-gram counts and numbers of letters; whole texts, a bounded amount at a time."""
    held: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= CHUNK_CHARS or len(held) == CHUNK_TEXTS or i == len(texts) - 1:
            yield _chunk_counts(held)
            held, size = [], 0


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length one, or all zero."""
    rows = np.log1p(counts).astype(np.float32) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


# ---- fitting ----


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without an id is not, but never serves for learning either."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``(lang, text)``: at most ``documents`` labelled documents of each language, chosen by a hash of id and text.

    Rows equal in language, id and text are one document, so no id that repeats fills the sample or a task.
    """
    usable = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", text_key())
    usable = usable.filter(~held_out(F.col("doc_id")))
    keys = ["lang", "doc_id", "text_key"]
    chosen = bounded_sample(usable.select(*keys), "lang", keys[1:], documents, 29).select(*keys)
    return usable.join(F.broadcast(chosen), keys, "left_semi").dropDuplicates(keys).select("lang", "text")  # a bounded sample


def cluster(rows: np.ndarray, clusters: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids of length one and each row's own. Starts at mutually far rows, so it is repeatable."""
    centres = [rows.mean(axis=0)]
    near = rows @ centres[0]
    for _ in range(min(clusters, len(rows)) - 1):
        pick = rows[int(near.argmin())]
        centres.append(pick)
        near = np.maximum(near, rows @ pick)
    centres = np.array(centres)
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    own = (rows @ centres.T).argmax(axis=1)
    for _ in range(rounds):
        for k in range(len(centres)):
            if (own == k).any():
                total = rows[own == k].sum(axis=0)
                centres[k] = total / max(float(np.linalg.norm(total)), 1e-12)
        after = (rows @ centres.T).argmax(axis=1)
        if (after == own).all():
            break
        own = after
    return centres, own


class Identifier:
    """Centroids learned from the documents that are not held out."""

    def __init__(self, docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, clusters: int = CLUSTERS) -> None:
        chosen = stored(sample(docs, documents), "languages", files=8)

        def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for counts, _ in count_vectors(batch["text"].tolist()):
                    at = (counts > 0).sum(axis=0)
                    yield pd.DataFrame({"gram": np.r_[np.arange(DIMENSIONS), -1], "n": np.r_[at, len(counts)]})

        found = chosen.mapInPandas(frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
        df = {r.gram: r.n for r in found}
        total = df.pop(-1, 0)
        idf = np.array([np.log((1 + total) / (1 + df.get(i, 0))) + 0.05 for i in range(DIMENSIONS)], np.float32)

        def fit(group: pd.DataFrame) -> pd.DataFrame:  # one language's bounded sample
            rows = weighted(np.concatenate([c for c, _ in count_vectors(sorted(group["text"]))]), idf)
            centres, own = cluster(rows, clusters)
            near = (rows * centres[own]).sum(axis=1)
            used = [k for k in range(len(centres)) if (own == k).any()]
            reach = [float(np.quantile(1 - near[own == k], REACH_QUANTILE)) * REACH_MARGIN for k in used]
            return pd.DataFrame({"lang": group["lang"].iloc[0], "part": used, "centre": [centres[k].astype(np.float32) for k in used], "reach": reach})

        parts = chosen.groupBy("lang").applyInPandas(fit, "lang string, part int, centre array<float>, reach double").collect()
        if len(parts) > MOST_CENTROIDS:
            raise ValueError(f"{len(parts)} centroids; at most {MOST_CENTROIDS} are expected")
        parts.sort(key=lambda r: (r.lang, r.part))
        self.langs = [r.lang for r in parts]
        centres = np.array([r.centre for r in parts], np.float32).reshape(-1, DIMENSIONS)
        self.held = docs.sparkSession.sparkContext.broadcast((self.langs, centres, np.array([r.reach for r in parts]), idf))

    def predict(self, docs: DataFrame) -> DataFrame:
        """Per row: doc_id, lang_pred, score and rejected; only the text decides."""
        held = self.held

        def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            langs, centres, reach, idf = held.value
            names = np.array([*langs, UNKNOWN], object)
            for batch in batches:
                best, score, far = [], [], []
                for counts, letters in count_vectors(batch["text"].tolist()):
                    if not len(langs):
                        best.append(np.full(len(counts), -1)), score.append(np.zeros(len(counts))), far.append(np.ones(len(counts), bool))
                        continue
                    near = weighted(counts, idf) @ centres.T
                    pick = near.argmax(axis=1)
                    top = near[np.arange(len(pick)), pick].astype(float)
                    best.append(np.where(letters > 0, pick, -1))
                    score.append(np.where(letters > 0, np.clip(top, 0, 1), 0.0))
                    far.append((letters == 0) | (1 - top > reach[pick]))
                if len(batch):
                    yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": names[np.concatenate(best)], "score": np.concatenate(score), "rejected": np.concatenate(far)})

        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        return texts.mapInPandas(compute, "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, clusters: int = CLUSTERS) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (cosine with the nearest centroid, 0 to 1) and rejected.

    ``lang_pred`` is a learned language, or ``und`` where the text is null or has no letter (score 0), or where nothing could be
    learned. ``rejected`` marks texts further from the nearest centroid than its own documents are. Ties go to the first
    language by name; repeated rows come back each; extra columns are ignored.
    """
    found = Identifier(docs, documents, clusters).predict(docs)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
