"""Document fingerprints from closed syncmers, in SQL functions only.

A text is a sequence of words. Of its runs of ``K`` words those are chosen whose least inner run of ``S`` words
(by hash) is the first or the last inside: whether a run is chosen depends on nothing outside it, so equal stretches of two
texts give equal anchors wherever they stand. The fingerprint is the sketch of the least ``SKETCH`` anchor marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import stored
from kitchenlight.llm.ordering import with_neighbours

K, S = 5, 2
SKETCH = 64
_BLANK = " \t\n\x0b\x0c\r"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _chosen(pairs: Column, count: Column) -> Column:
    """Positions of the closed syncmers; ``pairs`` holds the hash of the two words at each position.

    With K = 5 and S = 2 a run has four inner runs: the first or the last must be least.
    """

    def closed(i: Column) -> Column:
        return F.least(F.get(pairs, i), F.get(pairs, i + 3)) <= F.least(F.get(pairs, i + 1), F.get(pairs, i + 2))

    return F.filter(F.sequence(F.lit(0), count - K), closed)


def _mark(pairs: Column, i: Column) -> Column:
    """32 bits of a hash of the five words at ``i``."""
    return F.shiftright(F.xxhash64(F.get(pairs, i), F.get(pairs, i + 2), F.get(pairs, i + 3)), 32).cast("int")


def _over_pairs(text: Column, body) -> Column:
    """``body(pairs, number of words, trimmed text)`` of a text."""

    def of_hashes(hashes: Column, trimmed: Column) -> Column:
        pairs = F.zip_with(hashes, F.slice(hashes, 2, F.size(hashes)), lambda a, b: F.xxhash64(a, b))
        return _let(pairs, lambda p: body(p, F.size(p), trimmed))

    def of_text(trimmed: Column) -> Column:
        return _let(F.transform(F.split(trimmed, r"[ \t\n\x0B\f\r]+"), lambda w: F.xxhash64(w)), lambda h: of_hashes(h, trimmed))

    return _let(F.btrim(text, F.lit(_BLANK)), of_text)


def anchors(text: Column) -> Column:
    """Array of ``(position, mark)``: the chosen runs of a text, by the number of their first word.

    A text of fewer than ``K`` words has one anchor, for the whole of it, and a text without words none.
    """

    def body(pairs: Column, count: Column, trimmed: Column) -> Column:
        found = F.transform(_chosen(pairs, count), lambda i: F.struct(i.alias("position"), _mark(pairs, i).alias("mark")))
        whole = F.array(F.struct(F.lit(0).alias("position"), F.shiftright(F.xxhash64(trimmed), 32).cast("int").alias("mark")))
        return F.when(trimmed == "", F.slice(whole, 1, 0)).when(count < K, whole).otherwise(found)

    return _over_pairs(F.coalesce(text, F.lit("")), body)


def sketch(text: Column, size: int = SKETCH) -> Column:
    """The least ``size`` distinct anchor marks in ascending order. A text in which no run is chosen is one mark."""

    def body(pairs: Column, count: Column, trimmed: Column) -> Column:
        whole = F.array(F.shiftright(F.xxhash64(trimmed), 32).cast("int"))

        def kept(marks: Column) -> Column:
            return F.when(F.size(marks) == 0, whole).otherwise(F.slice(F.sort_array(F.array_distinct(marks)), 1, size))

        found = _let(F.transform(_chosen(pairs, count), lambda i: _mark(pairs, i)), kept)
        return F.when(trimmed == "", F.slice(whole, 1, 0)).when(count < K, whole).otherwise(found)

    return _over_pairs(F.coalesce(text, F.lit("")), body)


def likeness(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Estimated share of common anchors of two sketches, 0 to 1; of two empty ones 1."""

    def of_union(least: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(least, a), b))
        return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(common / F.size(least))

    return _let(F.slice(F.sort_array(F.array_union(a, b)), 1, size), of_union)


def spelled(marks: Column) -> Column:
    """A sketch as text: eight hex digits a mark."""
    return F.array_join(F.transform(marks, lambda m: F.lpad(F.hex(m.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, size, marks)`` of every row; ``text_key`` tells rows of one id apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.char_length(text).cast("long").alias("size"), sketch(text).alias("marks")
    )


def _same(a: str, b: str, left: DataFrame, right: DataFrame) -> Column:
    return left[a].eqNullSafe(right["doc_id"]) & (left[b] == right["text_key"])


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has its last quarter (rounded down) of code points replaced by as many first ones of the next document.
    Documents follow one another by id and, where an id has several texts, by a hash of the text; equal rows count as
    one document there and each come back. Rows without an id come first; after the last follows the first. Null text counts as
    empty; texts without words have an empty fingerprint, and two such are alike (1); extra columns are ignored;
    an empty table gives no rows.

    A text travels once, by its id and hash; only the start that its predecessor needs travels on.
    """
    marks = stored(fingerprints(docs), "marks").dropDuplicates(["doc_id", "text_key"])
    ids = with_neighbours(marks.select("doc_id", "text_key", "size"), ["doc_id", "text_key"], ["doc_id", "text_key"], last_takes_first=True)
    follow = stored(ids.select("doc_id", "text_key", "size", F.col("after.doc_id").alias("next_id"), F.col("after.text_key").alias("next_key")), "follow")

    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    wanted = follow.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "next_id", "next_key", F.floor(F.col("size") / 4).cast("int").alias("need"))
    heads = texts.join(wanted, _same("next_id", "next_key", wanted, texts)).select("own_id", "own_key", F.substring("text", F.lit(1), F.col("need")).alias("head"))
    heads = heads.groupBy(F.col("own_id").alias("doc_id"), F.col("own_key").alias("text_key")).agg(F.any_value("head").alias("head"))
    following = marks.join(wanted, _same("next_id", "next_key", wanted, marks)).select(F.col("own_id").alias("doc_id"), F.col("own_key").alias("text_key"), F.col("marks").alias("next_marks"))

    size = F.char_length(texts["text"])
    edited = F.concat(F.substring(texts["text"], F.lit(1), size - F.floor(size / 4).cast("int")), heads["head"])
    both = texts.join(heads, _same("doc_id", "text_key", texts, heads)).select(
        texts["doc_id"], texts["text_key"], size.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), sketch(edited).alias("edited_marks")
    )
    rated = both.join(marks, _same("doc_id", "text_key", both, marks)).select(both["*"], marks["marks"])
    rated = rated.join(following, _same("doc_id", "text_key", rated, following)).select(rated["*"], following["next_marks"])
    return rated.select(
        "doc_id", "n_chars", "edited_sha256", spelled(F.col("marks")).alias("fingerprint"), spelled(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"), likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
