"""Benchmark passages in documents, as a prefix-filtered set join.

Every window of ten item words (a shorter item is one window) is a set of
shingles. A document holds the window only if it holds all of its shingles, so one
shingle is prefix enough: the rarest, by counts over all documents; a window with a
shingle that no document holds is out. Places of prefix shingles in documents are
joined with the windows; a match fixes where the window would have to start, which
must lie inside the document together with its length. What remains is verified word
by word, against the words that stand around the place.

Windows, counts and matches are tables and meet in equi-joins. All that goes to the
tasks by broadcast are two bit fields of ``FILTER_BITS``, whatever the size of the benchmark:
they tell most shingles that no window has, and a wrong yes only costs a row in a join.
Places bear the 128-bit hash of their text, not a row number: equal texts are looked up
once, and documents are not shuffled for the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.common import batches, fresh_names, staged
from snapmart.llm.textkernel import ALNUM_LOWER, words
from snapmart.sources.staging import discard

WINDOW, SHINGLE = 10, 3
#: Bits of a broadcast filter (8 MB), a power of two. A million shingles set one bit in 64.
FILTER_BITS = 1 << 26


def windows(benchmark: DataFrame, size: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id as string, window): ``size`` consecutive words, or all of a shorter item's."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches("text", rows):
            w = words(texts, ALNUM_LOWER)
            ids, found = [], []
            for i, name in enumerate(batch.column(batch.schema.get_field_index("item_id")).to_pylist()):
                a, b = int(w.first[i]), int(w.first[i + 1])
                for at in range(a, max(b - size, a) + 1 if b > a else a):
                    ids.append(name)
                    found.append(w.joined(at, min(at + size, b)).decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.string())], ["item_id", "win"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "item_id string, win string").distinct()


def _shingles(found: DataFrame, shingle: int) -> DataFrame:
    """(win, length, k, h, at): the shingles of each window, k words from its word ``at`` on.

    A window of fewer than ``shingle`` words is one shingle of all of them.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches("win", rows):
            w = words(texts, ALNUM_LOWER)
            hashes, length = w.hashes(), np.diff(w.first)
            for k in np.unique(np.minimum(length, shingle)).tolist():
                mine = np.repeat(np.minimum(length, shingle) == k, length)
                place = np.flatnonzero(w.whole(k) & mine)
                doc = np.searchsorted(w.first, place, side="right") - 1
                columns = [texts.take(pa.array(doc)), length[doc], np.full(len(place), k), w.sequences(hashes, k)[place].view(np.int64), place - w.first[doc]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in columns], ["win", "length", "k", "h", "at"])

    return found.mapInArrow(run, "win string, length long, k long, h long, at long")


class Filter:
    """A bit for each hash modulo the number of bits, and the widths k that there are, for use in tasks."""

    def __init__(self, keys: DataFrame, bits: int):
        if bits < 1 or bits & (bits - 1):
            raise ValueError("the bits of a filter must be a power of two")
        position = F.pmod("h", F.lit(bits)) + 1
        chunks = keys.groupBy("k", F.bitmap_bucket_number(position).alias("chunk")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("set")
        )
        self.bits, field, self.widths = bits, np.zeros((-(-bits // 32768), 4096), np.uint8), set()
        # At most a row of 4 KB for each 32,768 bits and width.
        for row in chunks.toLocalIterator():
            field[row.chunk - 1] |= np.frombuffer(row.set, np.uint8)
            self.widths.add(row.k)
        self.field = keys.sparkSession.sparkContext.broadcast(field.reshape(-1))

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.field.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def __getstate__(self) -> dict:
        return {"bits": self.bits, "widths": self.widths, "field": self.field}


def _counts(docs: DataFrame, text: str, known: Filter) -> DataFrame:
    """(k, h, n): how often shingles stand in all documents; those that no window has are left out, but for a few."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in batches(text, rows):
            w = words(texts, ALNUM_LOWER)
            hashes = w.hashes()
            for k in known.widths:
                found = w.sequences(hashes, k)[w.whole(k)]
                h, n = np.unique(found[known.passes(found)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k, np.int64)), pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "h", "n"])

    return docs.select(text).mapInArrow(run, "k long, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n"))


def _places(docs: DataFrame, text: str, prefixes: Filter, window: int, shingle: int) -> DataFrame:
    """(a, b, k, h, place, before, around): where prefix shingles stand in texts of hashes a and b.

    ``around`` are the words that a window through this place could cover, ``before`` of them ahead of it.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches("text", rows):
            w = words(texts, ALNUM_LOWER)
            hashes = w.hashes()
            for k in prefixes.widths:
                found = w.sequences(hashes, k)
                at = np.flatnonzero(w.whole(k) & prefixes.passes(found))
                doc = np.searchsorted(w.first, at, side="right") - 1
                reach = window - k if k == shingle else 0
                lo, hi = np.maximum(w.first[doc], at - reach), np.minimum(w.first[doc + 1], at + k + reach)
                around = pa.array([w.joined(i, j).decode() for i, j in zip(lo.tolist(), hi.tolist(), strict=True)], pa.string())
                a, b = (batch.column(batch.schema.get_field_index(c)).take(pa.array(doc)) for c in ("a", "b"))
                numbers = [pa.array(v.astype(np.int64)) for v in (np.full(len(at), k), found[at].view(np.int64), at - w.first[doc], at - lo)]
                yield pa.RecordBatch.from_arrays([a, b, *numbers, around], ["a", "b", "k", "h", "place", "before", "around"])

    a, b = _digest(text)
    return docs.select(a.alias("a"), b.alias("b"), F.col(text).alias("text")).mapInArrow(
        run, "a long, b long, k long, h long, place long, before long, around string"
    )


def _digest(text: str) -> tuple[Column, Column]:
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole), F.xxhash64(F.lit("second"), whole)


def found_in_texts(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    filter_bits: int = FILTER_BITS,
    text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """(a, b, places, items) of each text that holds a window: the hashes of the text, the occurrences
    as {(first word, length)}, and the ids of the items, sorted as strings. Written to the staging folder."""
    if not 1 <= shingle:
        raise ValueError("a shingle has one word or more")
    listed = staged(windows(benchmark, window, item_id, text), "windows")
    shingles = staged(_shingles(listed.select("win").distinct(), shingle), "shingles")
    counts = _counts(docs, text, Filter(shingles.select("k", "h"), filter_bits))
    counted = shingles.join(counts, ["k", "h"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = counted.groupBy("win", "length", "k").agg(F.min(F.struct("n", "h", "at")).alias("_r")).where(F.col("_r.n") > 0)
    prefixes = staged(rarest.select("win", "length", "k", "_r.h", "_r.at"), "prefixes")

    # Equal texts have equal places: one row each, before they meet the windows.
    places = _places(docs, text, Filter(prefixes.select("k", "h"), filter_bits), window, shingle).distinct()
    start, covered = F.col("before") - F.col("at"), F.split("around", " ")
    same = F.array_join(F.slice(covered, (start + 1).cast("int"), F.col("length").cast("int")), " ") == F.col("win")
    inside = (start >= 0) & (start + F.col("length") <= F.size(covered))
    matches = places.join(prefixes, ["k", "h"]).where(F.when(inside, same).otherwise(False))
    hits = staged(matches.select("a", "b", "win", (F.col("place") - F.col("at")).alias("first"), "length"), "hits")

    stretches = hits.groupBy("a", "b").agg(F.collect_set(F.struct("first", "length")).alias("places"))
    named = hits.select("a", "b", "win").distinct().join(listed.where(F.col("item_id").isNotNull()), "win")
    items = named.groupBy("a", "b").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    found = staged(stretches.join(items, ["a", "b"], "left"), "contaminated")
    for done in (listed, shingles, prefixes, hits):
        discard(done)
    return found


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    columns: list[str] | None = None,
    names: tuple[str, str, str, str] = ("n_words", "n_hit", "items", "spans"),
    text: str = "text",
    **options,
) -> DataFrame:
    """``columns`` of the documents (all by default) and what was found in each.

    n_words; n_hit, the words inside any occurrence of a window; items, the ids of
    the items with occurring windows, sorted as strings; spans, the hit stretches
    as [first word, one past the last). A document or item that is null, empty or
    without words has none. Items may repeat; an item without an id marks words but
    is not listed. Rows come back as often as they came; a column of the documents
    that bears one of ``names`` is replaced. An empty benchmark finds nothing.
    ``options`` are those of ``found_in_texts``.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in {n.lower() for n in names}]
    schema = docs.select(*columns).schema.add(names[0], "long").add(names[1], "long").add(names[2], T.ArrayType(T.StringType()))
    schema = schema.add(names[3], T.ArrayType(T.StructType().add("first", "long").add("past", "long")))
    out_types = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))]
    a, b, places, listed = fresh_names(docs, "a", "b", "places", "items")
    found = found_in_texts(docs, benchmark, text=text, **options).toDF(a, b, places, listed)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(text, rows):
            kept = [batch.column(batch.schema.get_field_index(c)) for c in (*columns, a, b)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(words(texts, ALNUM_LOWER).first))], [*columns, a, b, names[0]])

    def mark(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            n_words, at, named = (batch.column(batch.schema.get_field_index(c)) for c in (names[0], places, listed))
            n_hit, spans = [], []
            for n, occurrences in zip(n_words.to_pylist(), at, strict=True):
                change = np.zeros(n + 1 if occurrences.is_valid else 1, np.int64)
                for place in occurrences.as_py() or ():
                    change[place["first"]] += 1
                    change[place["first"] + place["length"]] -= 1
                hit = np.cumsum(change)[:-1] > 0
                n_hit.append(int(hit.sum()))
                spans.append(_spans(hit))
            own = [pa.array(v, t) for v, t in zip((n_hit, [v or [] for v in named.to_pylist()], spans), out_types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in (*columns, names[0])), *own], [*columns, *names])

    # Words are counted where the documents are read: the text meets no join unless it is asked for.
    first, second = _digest(text)
    keyed = docs.select(*dict.fromkeys([*columns, text]), first.alias(a), second.alias(b))
    short = docs.select(*columns).schema.add(a, "long").add(b, "long").add(names[0], "long")
    return keyed.mapInArrow(count, short).join(found, [a, b], "left").drop(a, b).mapInArrow(mark, schema)


def _spans(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"first": int(a), "past": int(b)} for a, b in edge.reshape(-1, 2)]


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", filter_bits: int = FILTER_BITS, **options) -> DataFrame:
    """The documents without a benchmark window, all columns and repeated rows kept.

    A filter over the texts found tells most documents that they are clean where they are read; only the
    others are shuffled with their texts, to be compared with those found.
    """
    a, b, maybe = fresh_names(docs, "a", "b", "maybe")
    found = found_in_texts(docs, benchmark, text=text, filter_bits=filter_bits, **options)
    marked = Filter(found.select(F.lit(0).alias("k"), F.col("a").alias("h")), filter_bits)

    @F.pandas_udf("boolean")
    def passes(h: pd.Series) -> pd.Series:
        return pd.Series(marked.passes(h.to_numpy(np.int64).view(np.uint64)))

    first, second = _digest(text)
    keyed = docs.withColumn(a, first).withColumn(maybe, passes(a))
    asked = keyed.where(F.col(maybe)).withColumn(b, second)
    kept = asked.join(found.select(F.col("a").alias(a), F.col("b").alias(b)), [a, b], "left_anti")
    return keyed.where(~F.col(maybe)).select(*docs.columns).unionByName(kept.select(*docs.columns))
