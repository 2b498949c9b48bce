"""Near copies by the Jaccard similarity of word shingles: SimHash and MinHash bands for candidates, an exact check for links.

A text is the set of its runs of five words. Documents whose sets are equal are one class, so thousands of exact copies
cost one row. A class has a SimHash fingerprint of its set; classes that the bit-sliced comparison of ``simhash`` links, within its radius, share
a bucket. Three bits are a cosine near 0.99, and a wider radius has no tables whose buckets do not grow, so pairs down to ``SIMILARITY`` need bands
as well: a class has ``BANDS * BAND_ROWS`` least hash values; two classes that agree on a whole band meet in a bucket, which a pair of similarity 0.8 misses with a chance of about 5 in a million (a pair of 0.85 of 1 in 10**8). Pairs of a bucket
are linked if their exact similarity is ``SIMILARITY`` or more, and linked classes are contracted to components. Each bucket
is first compared with its least class only. Where that leaves a bucket in more than one component, its classes are compared
with each other tile by tile inside the tasks: what they yield is one link per class and tile pair at most, never the pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import only, sorted_runs, stored
from kitchenlight.llm.components import components
from kitchenlight.llm.simhash import BLOCKS, RADIUS, TILE_ROWS, linked_fingerprints, set_fingerprint

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 40
BAND_ROWS = 6
SEED = 42
CHUNK = 2048
TILE_CLASSES = 1024
TILE_SHINGLES = 1 << 20

_random = np.random.default_rng(SEED)
_FACTORS = (_random.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32) | np.uint32(1))[:, None]
_SHIFTS = _random.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32)[:, None]


# ---- sets and bands ----


def shingle_set(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles: A-Z lower-cased, ASCII-white-space words; a shorter text is one shingle."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else iter([b" ".join(parts)])
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64))


def band_keys(found: np.ndarray) -> np.ndarray:
    """One hash per band of the least values of a set under random permutations."""
    least = np.full(BANDS * BAND_ROWS, 0xFFFFFFFF, np.uint32)
    folded = (found >> np.uint64(32)).astype(np.uint32) ^ found.astype(np.uint32)
    for at in range(0, len(folded), CHUNK):  # a bounded stretch at a time
        np.minimum(least, (folded[None, at : at + CHUNK] * _FACTORS + _SHIFTS).min(axis=1), out=least)
    bands = least.reshape(BANDS, BAND_ROWS)
    return np.fromiter((xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(bands)), np.uint64, BANDS).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _marks(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, set_key, size, fp, bands)`` per row."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only(None)
        for batch in batches:
            sets = [shingle_set(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "text_key": batch["text_key"],
                "set_key": np.fromiter((xxhash.xxh64_intdigest(s.tobytes()) for s in sets), np.uint64, len(sets)).view(np.int64),
                "size": [len(s) for s in sets], "fp": np.fromiter(map(set_fingerprint, sets), np.uint64, len(sets)).view(np.int64), "bands": [band_keys(s) for s in sets],
            })

    return docs.mapInPandas(compute, "doc_id long, text_key long, set_key long, size long, fp long, bands array<long>")


def _simhash_buckets(classes: DataFrame) -> DataFrame:
    """``(band, bucket, set_key, size, holder)``: classes whose fingerprints are linked share a bucket, as if in one more band."""
    marks = stored(classes.select("fp").distinct(), "fingerprints")
    roots = linked_fingerprints(marks, RADIUS, BLOCKS, TILE_ROWS)
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    return named.select(F.lit(BANDS).alias("band"), F.xxhash64(F.lit(BANDS), "root").alias("bucket"), "set_key", "size", "holder")


# ---- links ----


def _linked(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``(u, v)`` of classes whose sets are similar."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [similarity(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= least for a, b in zip(batch["a"], batch["b"])]
            yield batch.loc[np.array(good, bool), ["u", "v"]]

    one, two = (sets.select(F.col("set_key").alias(k), F.col("shingles").alias(s)) for k, s in (("u", "a"), ("v", "b")))
    return pairs.distinct().join(one, "u").join(two, "v").mapInPandas(check, "u long, v long")


def tile_links(sets: list[np.ndarray], bands: np.ndarray, band: int, roots: np.ndarray, tiles: np.ndarray, least: float) -> tuple[list[int], list[int]]:
    """Links that connect, beyond ``roots``, what similar pairs of one bucket connect: at most one less than there are classes.

    With two ``tiles`` only pairs across them count. A pair that shares an earlier band than ``band`` is left to that band's bucket,
    and one whose ends are connected already is not compared.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, group = np.unique(roots, return_inverse=True)
    across = tiles.min() != tiles.max()
    one, two = [], []
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        fits = np.minimum(sizes[rest], sizes[i]) >= np.maximum(sizes[rest], sizes[i]) * least
        rest = rest[fits & (group[rest] != group[i]) & ((tiles[rest] != tiles[i]) if across else True)]
        rest = rest[~(bands[rest, :band] == bands[i, :band]).any(axis=1)]
        if not len(rest):
            continue
        found = np.concatenate([sets[j] for j in rest])
        shared = sets[i][np.minimum(np.searchsorted(sets[i], found), sizes[i] - 1)] == found
        both = np.add.reduceat(shared.astype(np.int64), np.r_[0, np.cumsum(sizes[rest])[:-1]])
        for j in rest[both / (sizes[i] + sizes[rest] - both) >= least].tolist():
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                one.append(i)
                two.append(j)
    return one, two


def _bucket_links(rows: DataFrame, sets: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """``(u, v)``: links between the components of each bucket; ``rows`` has bucket, band, set_key, size and root."""
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    tiles = F.greatest(F.ceil(F.col("n") / TILE_CLASSES), F.ceil(F.col("total") / TILE_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("set_key"), F.col("tiles")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda other: F.xxhash64("bucket", F.least("own", other), F.greatest("own", other)))
    dealt = rows.join(counts.select("bucket", tiles.alias("tiles")), "bucket").withColumn("own", own)
    dealt = dealt.select(F.explode(pairs).alias("part"), "band", "own", "root", "set_key")
    filled = dealt.join(sets, "set_key").join(classes.select("set_key", "bands"), "set_key")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in sorted_runs(batches, "part", 1):
            for _, part in frame.groupby("part", sort=False):
                held = [np.frombuffer(shingles, np.uint64) for shingles in part["shingles"]]
                one, two = tile_links(held, np.stack(part["bands"].to_list()), int(part["band"].iloc[0]), part["root"].to_numpy(), part["own"].to_numpy(), least)
                keys = part["set_key"].to_numpy()
                yield pd.DataFrame({"u": keys[one], "v": keys[two]})

    return filled.repartition("part").sortWithinPartitions("part").mapInPandas(compare, "u long, v long")


def near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``(doc_id, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of similarity ``least`` or more, the row's own included.
    Null and empty texts are copies of each other; rows with a null ``doc_id`` take part, but an id is only null if a
    whole component has none; repeated rows each come back; extra columns are ignored; an empty table gives no rows.
    """
    return _grouped(docs, least).select("doc_id", "component_id")


def _grouped(docs: DataFrame, least: float) -> DataFrame:
    """``(doc_id, text_key, root, component_id)`` per row; ``root`` names the component, also where ids repeat."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    marks = stored(_marks(texts), "marks")
    classes = marks.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("text_key", "doc_id")).alias("holder"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    full = classes.filter("size > 0")
    rows = full.select(F.posexplode("bands").alias("band", "bucket"), "set_key", "size", "holder").unionByName(_simhash_buckets(full))
    heads = rows.groupBy("bucket").agg(F.min(F.struct("set_key", "size")).alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    shared = stored(rows.join(heads, "bucket"), "buckets")

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"set_key": batch["set_key"], "shingles": [shingle_set(t).tobytes() for t in batch["text"]]})

    # one row holds the text of a class: of thousands of copies, only that one's text travels
    wanted = shared.select("set_key", F.col("holder.text_key").alias("held_key"), F.col("holder.doc_id").alias("held_id")).distinct()
    held = texts.join(wanted, (F.col("text_key") == F.col("held_key")) & F.col("doc_id").eqNullSafe(F.col("held_id")))
    kept = held.dropDuplicates(["set_key"]).select("set_key", "text")
    sets = stored(kept.mapInPandas(shingles, "set_key long, shingles binary"), "shingles")

    def possible(a: str, b: str) -> Column:  # sets of too different sizes need no comparison
        return F.least(a, b) >= F.greatest(a, b) * least

    to_head = shared.filter((F.col("set_key") != F.col("head.set_key")) & possible("size", "head.size"))
    links = stored(_linked(to_head.select(F.col("head.set_key").alias("u"), F.col("set_key").alias("v")), sets, least), "links")
    roots = components(links)
    rooted = shared.join(roots, shared.set_key == roots.node, "left").select("bucket", "band", "set_key", "size", F.coalesce("root", "set_key").alias("root"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("bucket")
    left = stored(rooted.join(mixed, "bucket", "left_semi"), "mixed")
    links = links.unionByName(stored(_bucket_links(left, sets, classes, least), "links"))

    ends = components(links)
    joined = classes.select("set_key", "first_id").join(ends, F.col("set_key") == F.col("node"), "left").select("set_key", "first_id", F.coalesce("root", "set_key").alias("root"))
    first = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = joined.join(first, "root").select("set_key", "root", "component_id")
    return marks.select("doc_id", "text_key", "set_key").join(named, "set_key").select("doc_id", "text_key", "root", "component_id")


def drop_near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each group stays: the one with the smallest ``doc_id``, then the smallest text hash. Columns are kept.

    Groups are told apart by their texts: rows that share an id but not a text stand for themselves, and none is lost. Of rows equal in
    id and text one stays. Rows without a ``doc_id`` cannot be told apart and stay.
    """
    rows = _grouped(docs.select("doc_id", "text"), least).filter("doc_id IS NOT NULL")
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("first")).select("first.doc_id", "first.text_key")
    key = f"text_key_{uuid.uuid4().hex}"
    first = first.withColumnRenamed("text_key", key)
    numbered = docs.filter("doc_id IS NOT NULL").withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    numbered = numbered.join(first, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key])
    return numbered.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
