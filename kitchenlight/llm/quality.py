"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, order 5. Its n-gram counts, continuation counts, discounts and back-off weights are Spark
tables dealt by n-gram, joined context by context; they come from all trusted documents but the quarter held out. The finished
model is broadcast, and each task lays it out as arrays in which a character's probability is one look-up. A model too large for that is
cut into parts by the last two characters of a context, which decide alone what a place needs: a task adds up what each part gives for
its own places. Thresholds are quantiles of the perplexity of the held-out trusted documents, one per language.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kitchenlight.llm.common import bounded_sample, only, stored, text_key, text_slices

ORDER = 5
BITS = 7
SYMBOLS = 1 << BITS
OTHER, START = 0, 1
MOST_CONTEXTS = 150_000
PART_ROWS = 3_000_000
PART_CONTEXTS = 100_000
BLOCK_BYTES = 64 << 20
QUANTILE = 0.995
MARGIN = 1.05
EVIDENCE = 20.0
GRID = 1e-4
MOST_LANGUAGES = 10_000
LEAST_OWN = 5
CHUNK_CHARS = 1 << 20

_LOW = SYMBOLS - 1


# ---- training text ----


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Distinct ids that some label row calls good and none calls bad or toxic."""
    by_id = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = by_id.agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return good.filter("q = 1 AND t = 0").select("doc_id")


def _learned() -> Column:
    """Whether an id is one of the three in four that the model may learn from."""
    return F.pmod(F.xxhash64(F.lit(41), "doc_id"), F.lit(4)) != 0


def training_ids(docs: DataFrame, trusted: DataFrame, documents: int | None = None, chars: int | None = None) -> DataFrame:
    """``(doc_id, text_key)`` of the trusted documents that the model learns from: all but one trusted id in four.

    That quarter sets the thresholds. Rows equal in id and text are one document; other texts of a trusted id are documents of their own.
    Only where asked for, at most ``documents`` of a language, or about ``chars`` characters of text, are taken, by a hash of id and text.
    """
    trusted = trusted.filter(_learned())
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), F.char_length("text").alias("size"), text_key())
    taken = sized.join(trusted, "doc_id", "left_semi")
    if documents is not None or chars is not None:
        most = documents if documents is not None else docs.count()
        first = bounded_sample(taken, "lang", ["doc_id", "text_key"], most, 17)
        before = F.sum("size").over(Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
        limit = F.lit(True) if chars is None else F.col("before") < chars
        taken = first.withColumn("before", F.coalesce(before, F.lit(0))).filter(limit)
    return taken.select("doc_id", "text_key").distinct()


# ---- model ----


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return table[np.minimum(points, len(table) - 1)]


def symbol_table(texts: DataFrame) -> np.ndarray:
    """Code point to symbol: the most frequent characters have one each, all others share ``OTHER``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = np.frombuffer("".join(batch["text"]).encode("utf-32-le", "surrogatepass"), np.uint32)
            point, n = np.unique(points, return_counts=True)
            yield pd.DataFrame({"point": point.astype(np.int64), "n": n})

    counts = texts.mapInPandas(count, "point long, n long").filter("point < 65535").groupBy("point").agg(F.sum("n").alias("n"))
    table = np.zeros(1 << 16, np.uint8)
    for i, row in enumerate(counts.orderBy(F.desc("n"), "point").limit(SYMBOLS - 2).collect()):
        table[row.point] = i + 2
    return table


def _codes(symbols: np.ndarray) -> np.ndarray:
    """The n-gram of ``ORDER`` symbols that ends at each place from ``ORDER - 1`` on."""
    wide = symbols.astype(np.int64)
    code = wide[: len(wide) - ORDER + 1].copy()
    for i in range(1, ORDER):
        code = code << BITS | wide[i : len(wide) - ORDER + 1 + i]
    return code


def _count_tables(texts: DataFrame, table: np.ndarray) -> list[DataFrame]:
    """Per order from 1: ``(code, n)``; the highest holds counts, the others numbers of distinct left neighbours."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pad = np.full(ORDER - 1, START, np.uint8)
        for batch in batches:
            codes = [_codes(np.concatenate([pad, symbols_of(t, table)])) for t in batch["text"] if t]
            code, n = np.unique(np.concatenate(codes) if codes else np.zeros(0, np.int64), return_counts=True)
            yield pd.DataFrame({"code": code, "n": n})

    counts = texts.mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    tables = [stored(counts, "ngrams")]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("code").bitwiseAND(F.lit((1 << BITS * order) - 1)).alias("code")
        tables.insert(0, stored(tables[0].groupBy(shorter).agg(F.count("*").alias("n")), "ngrams"))
    return tables


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen once to four times."""
    if not (n1 and n2 and n3):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


def model_tables(texts: DataFrame, table: np.ndarray) -> DataFrame:
    """``(sort, code, value)``: the discounted share of each n-gram and, negated order, the back-off weight of each context."""
    out = []
    for order, counts in enumerate(_count_tables(texts, table), 1):
        seen = counts.agg(*(F.coalesce(F.count_if(F.col("n") == i), F.lit(0)).alias(f"n{i}") for i in (1, 2, 3, 4))).first()
        d1, d2, d3 = discounts(*seen)
        less = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        context = F.shiftright("code", BITS)
        sums = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.sum(less).alias("freed"))
        shares = counts.withColumn("context", context).join(sums, "context").select(F.lit(order).alias("sort"), "code", ((F.col("n") - less) / F.col("total")).alias("value"))
        weights = sums.select(F.lit(-order).alias("sort"), F.col("context").alias("code"), (F.col("freed") / F.col("total")).alias("value"))
        out += [shares, weights]
    return reduce(DataFrame.unionByName, out)


def _pair() -> Column:
    """The last two symbols of a row's context as one number; -1 for the contexts that are shorter."""
    context = F.when(F.col("sort") > 0, F.shiftright("code", BITS)).otherwise(F.col("code"))
    return F.when(F.abs("sort") >= 3, context.bitwiseAND(F.lit(SYMBOLS**2 - 1))).otherwise(-1).alias("pair")


def part_ends(pairs: list[tuple[int, int, int]]) -> list[int]:
    """Where parts of the model end, each a range of pairs; ``pairs`` lists ``(pair, rows, contexts of three)`` by pair.

    A part has at most ``PART_ROWS`` rows and ``PART_CONTEXTS`` contexts, or one pair, which has no more than the alphabet allows.
    """
    ends, rows, contexts = [], 0, 0
    for pair, more_rows, more_contexts in pairs:
        rows, contexts = rows + more_rows, contexts + more_contexts
        if rows > PART_ROWS or contexts > PART_CONTEXTS:
            ends.append(pair)
            rows, contexts = more_rows, more_contexts
    return [end for end in ends if end > pairs[0][0]] + [SYMBOLS**2]


class Model:
    """The model laid out as arrays: probabilities of all symbols after each context, back-off already worked in.

    It answers for the places whose context ends in a pair of symbols from ``low`` up to ``high``; the rows need be those of these pairs only.

    Of the highest order, the ``MOST_CONTEXTS`` contexts with most successors are laid out; n-grams of the others are searched for
    in sorted arrays and worked out place by place, which gives the same probabilities in less memory.
    """

    def __init__(self, table: np.ndarray, sort: np.ndarray, code: np.ndarray, value: np.ndarray, low: int = 0, high: int = SYMBOLS**2) -> None:
        self.table, self.low, self.high = table, low, high
        part = {k: (code[sort == k], value[sort == k]) for k in (*range(1, ORDER + 1), *range(-ORDER, 0))}

        def layer(order: int, contexts: np.ndarray, rows: np.ndarray) -> np.ndarray:
            """Probabilities by context (sorted), made in place from those of the contexts without their first symbol."""

            def known(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                place = np.searchsorted(contexts, found)
                return place, contexts[np.minimum(place, len(contexts) - 1)] == found

            at, weight = part[-order]
            place, there = known(at)
            rows[place[there]] *= weight[there, None].astype(rows.dtype)
            grams, share = part[order]
            place, there = known(grams >> BITS)
            rows[place[there], grams[there] & _LOW] += share[there].astype(rows.dtype)  # n-grams are distinct
            return rows

        one = layer(1, np.zeros(1, np.int64), np.full((1, SYMBOLS), 1 / SYMBOLS))
        two = layer(2, np.arange(SYMBOLS), np.repeat(one, SYMBOLS, axis=0))
        three = layer(3, np.arange(SYMBOLS**2), two.astype(np.float32)[np.arange(SYMBOLS**2) & _LOW])
        self.third = np.sort(part[-4][0])
        four = layer(4, self.third, three[self.third & (SYMBOLS**2 - 1)])
        at, weight = (column[np.argsort(part[-5][0])] for column in part[-5])
        wide = np.bincount(np.searchsorted(at, part[5][0] >> BITS), minlength=len(at))
        laid_out = np.zeros(len(at), bool)
        laid_out[np.argsort(-wide, kind="stable")[:MOST_CONTEXTS]] = True
        self.fourth = at[laid_out]
        self.rare, self.rare_weight = at[~laid_out], weight[~laid_out]
        mine = ~laid_out[np.searchsorted(at, part[5][0] >> BITS)]
        by_code = np.argsort(part[5][0][mine])
        self.rare_grams, self.rare_share = (column[mine][by_code] for column in part[5])
        self.of_three = np.zeros(SYMBOLS**3, np.int32)
        self.of_three[self.third] = np.arange(1, len(self.third) + 1)
        five = np.zeros((0, SYMBOLS), np.float32)
        if len(self.fourth):
            five = layer(5, self.fourth, four[self.of_three[self.fourth & (SYMBOLS**3 - 1)] - 1])
        heads, head = np.unique(self.fourth >> BITS, return_inverse=True)  # these may end in a pair of another part
        self.of_head = np.zeros(SYMBOLS**3, np.int32)
        self.of_head[heads] = np.arange(1, len(heads) + 1)
        self.of_four = np.zeros((len(heads) + 1) * SYMBOLS, np.int32)
        self.of_four[(head + 1) * SYMBOLS + (self.fourth & _LOW)] = np.arange(1, len(self.fourth) + 1)
        self.logs = [np.log(rows, out=rows).reshape(-1) for rows in (three, four, five)]

    def log_probabilities(self, symbols: np.ndarray) -> tuple[slice | np.ndarray, np.ndarray]:
        """The places it answers for, counted from the ``ORDER - 1``-th symbol on, and the natural logarithm of the probability at each."""
        wide = symbols.astype(np.int32)
        three = wide[:-2] << 2 * BITS | wide[1:-1] << BITS | wide[2:]
        mine: slice | np.ndarray = slice(None)
        if (self.low, self.high) != (0, SYMBOLS**2):
            pair = three[1:-1] & (SYMBOLS**2 - 1)
            mine = np.flatnonzero((pair >= self.low) & (pair < self.high))
        head, context, before, last = three[:-2][mine], three[1:-1][mine], wide[3:-1][mine], wide[4:][mine]
        four = self.of_four[self.of_head[head] * SYMBOLS + before]
        out = self.logs[2][np.maximum(four - 1, 0) * SYMBOLS + last] if len(self.fourth) else np.zeros(len(last), np.float32)
        rest = np.flatnonzero(four == 0)
        if len(rest):
            near, end = self.of_three[context[rest]], last[rest]
            shorter = self.logs[0][(context[rest] & (SYMBOLS**2 - 1)) * SYMBOLS + end]
            longer = self.logs[1][np.maximum(near - 1, 0) * SYMBOLS + end] if len(self.third) else shorter
            out[rest] = np.where(near > 0, longer, shorter)
            if len(self.rare):
                long = head[rest].astype(np.int64) << BITS | before[rest]
                place = np.minimum(np.searchsorted(self.rare, long), len(self.rare) - 1)
                there = np.flatnonzero(self.rare[place] == long)
                gram = long[there] << BITS | end[there]
                found = np.minimum(np.searchsorted(self.rare_grams, gram), len(self.rare_grams) - 1)
                share = np.where(self.rare_grams[found] == gram, self.rare_share[found], 0.0)
                out[rest[there]] = np.log(share + self.rare_weight[place[there]] * np.exp(out[rest[there]].astype(np.float64)))
        return mine, out

    def log_sums(self, texts: list[str]) -> np.ndarray:
        """Sum of the log probabilities of the places of each text that it answers for; whole texts, in bounded chunks."""
        pad = np.full(ORDER - 1, START, np.uint8)
        sums = np.zeros(len(texts))
        held: list[int] = []
        size = 0
        for i in range(len(texts)):
            held.append(i)
            size += len(texts[i]) + ORDER - 1
            if size >= CHUNK_CHARS or i == len(texts) - 1:
                parts = [np.concatenate([pad, symbols_of(texts[j], self.table)]) for j in held]
                mine, found = self.log_probabilities(np.concatenate(parts))
                logs = np.zeros(sum(map(len, parts)) - (ORDER - 1), np.float32)
                logs[mine] = found
                ends = np.cumsum([len(p) for p in parts]) - (ORDER - 1)
                for j, end in zip(held, ends.tolist()):
                    sums[j] = logs[end - len(texts[j]) : end].sum(dtype=np.float64)
                held, size = [], 0
        return sums

    def cross_entropies(self, texts: list[str]) -> np.ndarray:
        """Mean negative log probability per character of each text, NaN for empty ones."""
        return _entropies(self.log_sums(texts), np.array([len(t) for t in texts]))


def _entropies(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(sizes > 0, -sums / sizes, np.nan)


def _blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of batches of at least ``least`` bytes; the last may be smaller."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield held
            held, size = [], 0
    if held:
        yield held


class Classifier:
    """A trained model; its parts are broadcast and laid out in the worker processes, one at a time."""

    def __init__(self, docs: DataFrame, labels: DataFrame, documents: int | None = None, chars: int | None = None) -> None:
        spark = docs.sparkSession
        self.trusted = trusted_ids(labels)
        self.sample = stored(training_ids(docs, self.trusted, documents, chars), "sample")
        text = docs.filter("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key())
        # texts are dealt by id and text at every size: nothing that grows is broadcast, and a repeated row is dropped before it travels
        once = text.filter(_learned()).dropDuplicates(["doc_id", "text_key"])
        chosen = once.join(self.sample.hint("merge"), ["doc_id", "text_key"], "left_semi")
        texts = stored(chosen.select("text"), "trusted")
        table = symbol_table(texts)
        model = stored(model_tables(texts, table).select("*", _pair()), "model")
        sizes = model.filter("pair >= 0").groupBy("pair").agg(F.count("*").alias("n"), F.count_if(F.col("sort") == 1 - ORDER).alias("contexts"))
        ends = part_ends([tuple(row) for row in sizes.orderBy("pair").collect()])  # at most SYMBOLS ** 2 rows
        self.parts = []
        for low, high in zip([0, *ends], ends):
            found = model.filter((F.col("pair") < 0) | (F.col("pair") >= low) & (F.col("pair") < high)).select("sort", "code", "value").toArrow()
            arrays = [found[name].to_numpy() for name in ("sort", "code", "value")]
            self.parts.append((uuid.uuid4().hex, spark.sparkContext.broadcast((table, *arrays, low, high))))
        self.held = self.parts[0][1]

    def scored(self, docs: DataFrame, entropy: str = "entropy") -> DataFrame:
        """``docs`` with the cross entropy per character; null where there is no text."""
        parts = self.parts
        least = BLOCK_BYTES if len(parts) > 1 else 0

        def laid_out(held: Broadcast) -> Model:
            model = Model(*held.value)
            vars(held).pop("_value", None)  # the worker's copy; the broadcast stays
            return model

        def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches, least):
                sums = [np.zeros(len(batch)) for batch in block]
                for key, held in parts:
                    model = only(key, lambda: laid_out(held))
                    for batch, total in zip(block, sums):
                        total += np.concatenate([model.log_sums(texts) for texts in text_slices(batch)] or [np.zeros(0)])
                for batch, total in zip(block, sums):
                    found = _entropies(total, pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy())
                    column = pa.array(found, pa.float64(), mask=np.isnan(found))
                    yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, entropy])

        return docs.mapInArrow(compute, docs.withColumn(entropy, F.lit(None).cast("double")).schema)

    def thresholds(self, scores: DataFrame, quantile: float = QUANTILE, least: int = LEAST_OWN) -> DataFrame:
        """``(lang, threshold)`` from all trusted documents that the model did not learn from; ``scores`` has doc_id, lang, entropy.

        A language's threshold is the smallest grid value with at least ``quantile`` of its trusted documents
        at or under it, times ``MARGIN`` in perplexity. Languages with fewer than ``least`` such documents have no
        row.
        """
        rated = scores.join(self.trusted, "doc_id", "left_semi").join(self.sample, "doc_id", "left_anti").filter("entropy IS NOT NULL")
        cells = rated.groupBy("lang", F.ceil(F.col("entropy") / GRID).alias("cell")).agg(F.count("*").alias("n"))
        up_to = Window.partitionBy("lang").orderBy("cell")
        return (
            cells.withColumn("under", F.sum("n").over(up_to)).withColumn("total", F.sum("n").over(Window.partitionBy("lang")))
            .filter((F.col("under") >= quantile * F.col("total")) & (F.col("total") >= least)).groupBy("lang").agg((F.min("cell") * GRID + F.lit(float(np.log(MARGIN)))).alias("threshold"))
        )


def _decided(rows: DataFrame, limits: DataFrame, size: Column) -> DataFrame:
    """``rows`` with ``limit`` and ``keep``; ``limits`` has one row per language and is checked to be small.

    ``size`` is a text's number of characters. A few characters prove little: a text is rejected for an excess over
    the limit of at least ``EVIDENCE`` nats in all. A language without a limit of its own keeps every text.
    """
    if (count := limits.count()) > MOST_LANGUAGES:
        raise ValueError(f"{count} languages; at most {MOST_LANGUAGES} are expected")
    named = limits.select(F.col("lang").alias("limit_lang"), F.col("threshold").alias("limit"))
    joined = rows.join(F.broadcast(named), F.coalesce(rows["lang"], F.lit("")) == F.col("limit_lang"), "left")
    limit = F.coalesce("limit", F.lit(float("inf")))
    excess = (F.col("entropy") - F.col("limit")) * size
    return joined.withColumn("limit", limit).withColumn("keep", F.col("entropy").isNotNull() & (excess < EVIDENCE))


def rate(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, documents: int | None = None, chars: int | None = None) -> DataFrame:
    """Per row: doc_id, lang, perplexity, threshold and ``keep``.

    Rows without text have a null perplexity and are not kept. A null language counts as one of its own; every language
    is judged by its own threshold only, and one with fewer than ``LEAST_OWN`` trusted documents to set it by keeps every
    text (its threshold is infinite). Documents as good as their threshold are kept, and so are those whose text is too short to tell. Repeated rows are rated each; extra columns are ignored.
    """
    classifier = Classifier(docs, labels, documents, chars)
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("lang"))
    scores = stored(classifier.scored(mine).select("doc_id", "lang", "entropy", F.char_length("text").alias("size")), "scores")
    found = _decided(scores, stored(classifier.thresholds(scores, quantile), "limits", files=1), F.col("size"))
    return found.select("doc_id", F.nullif("lang", F.lit("")).alias("lang"), F.exp("entropy").alias("perplexity"), F.exp("limit").alias("threshold"), "keep")


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, documents: int | None = None, chars: int | None = None) -> DataFrame:
    """The rows that ``rate`` keeps, with the columns of ``docs``. Texts are scored again rather than shuffled."""
    classifier = Classifier(docs, labels, documents, chars)
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("lang"))
    scores = stored(classifier.scored(mine).select("doc_id", "lang", "entropy"), "scores")
    limits = stored(classifier.thresholds(scores, quantile), "limits", files=1)
    plain = docs.withColumnsRenamed({c: f"own_{c}" for c in docs.columns if c not in ("doc_id", "text", "lang")})
    kept = _decided(classifier.scored(plain), limits, F.char_length("text")).filter("keep").select(*plain.columns)
    return kept.toDF(*docs.columns)
