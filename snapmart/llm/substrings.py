"""Passages repeated across documents, by level-wise doubling.

A window of words that stands in two documents is repeated; one of twice the length
can only be if both its halves are. So the windows of the first length are looked
at everywhere, and those of each doubled length only where both halves survived,
until the length asked for is reached or no candidate is left.

At the first level not every position has to be shuffled. Each window of twice the
length is stood for by its anchor, the leftmost of the least hashes among the first
windows in it: equal windows have equal anchors, so a window whose anchor stands in
one document only is not repeated. That leaves about one position in thirteen.

Windows are compared by two 64-bit hashes, each over 64-bit hashes of the words.
Equal texts are represented by the one with the smallest doc_id. Repeats are found
by aggregates that combine before the shuffle, and told to the documents by joins,
whose hot keys adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import batches, staged, utf8
from snapmart.llm.textkernel import SPACED, Words, expand, text_bytes, words
from snapmart.sources.staging import discard

LENGTH = 50
#: A null doc_id ranks after every other.
LAST = (1 << 63) - 1


def _anchors(w: Words, hashes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each whole window of twice the length, the anchor's place, the anchors' hashes by place)."""
    first = w.sequences(hashes, start, 1)
    begin = np.flatnonzero(w.whole(2 * start))
    if not len(begin):
        return begin, begin, first
    # In blocks: the sliding view itself needs no memory, the gathered rows do.
    place = np.empty(len(begin), np.int64)
    view = sliding_window_view(first, start + 1)
    for i in range(0, len(begin), 65536):
        part = begin[i : i + 65536]
        place[i : i + 65536] = part + view[part].argmin(axis=1)
    return begin, place, first


def _sha(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> str:
    return hashlib.sha256(_joined(data, start, end)).hexdigest()


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """The words at these places, one space between them."""
    if not len(start):
        return b""
    size = end - start + 1
    out = data[np.minimum(expand(start, size), len(data) - 1)]
    out[np.cumsum(size) - 1] = 0x20
    return out[:-1].tobytes()


def _scanned(docs: DataFrame, start: int) -> DataFrame:
    """(id, th, n_words, sha, anchors): of each document the digest of all its words and its distinct anchors."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches("text", rows):
            w = words(texts, SPACED)
            raw, _ = text_bytes(texts)
            _, place, first = _anchors(w, w.hashes(), start)
            place = np.unique(place)
            cut = np.searchsorted(place, w.first)
            found = [np.unique(first[place[a:b]]).view(np.int64) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            sha = [_sha(raw, w.start[a:b], w.end[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(w.first)), pa.array(sha), lists], ["id", "th", "n_words", "sha", "anchors"]
            )

    return docs.select("id", "th", "text").mapInArrow(run, "id long, th binary, n_words long, sha string, anchors array<long>")


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys that stand in documents of different ids, and the smallest of these."""
    return rows.groupBy(*keys).agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")


def _known(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The hashes told to each document, one after the other, and where each document's begin."""
    column = batch.column(batch.schema.get_field_index("known"))
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), offsets - offsets[0]


def _windows(docs: DataFrame, start: int, length: int) -> DataFrame:
    """(rid, id, a, b): the distinct windows of ``length`` of each document whose halves (or anchor) are ``known``, two hashes each."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches("text", rows):
            w = words(texts, SPACED)
            hashes = w.hashes()
            known, cut = _known(batch)
            if length == 2 * start:
                begin, place, first = _anchors(w, hashes, start)
                parts = (first[place],)
            else:
                begin = np.flatnonzero(w.whole(length))
                half = w.sequences(hashes, length // 2)
                parts = (half[begin], half[begin + length // 2])
            bounds = np.searchsorted(begin, w.first)
            keep = np.ones(len(begin), bool)
            for i in range(len(texts)):
                own = slice(bounds[i], bounds[i + 1])
                for part in parts:
                    keep[own] &= np.isin(part[own], known[cut[i] : cut[i + 1]])
            begin = begin[keep]
            one, two = w.sequences(hashes, length)[begin], w.sequences(hashes, length, 1)[begin]
            doc = np.searchsorted(w.first, begin, side="right") - 1
            order = np.lexsort((one, doc))
            one, two, doc = one[order], two[order], doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (one[1:] != one[:-1])
            take = pa.array(doc[new])
            ids = (batch.column(batch.schema.get_field_index(c)).take(take) for c in ("rid", "id"))
            yield pa.RecordBatch.from_arrays([*ids, pa.array(one[new].view(np.int64)), pa.array(two[new].view(np.int64))], ["rid", "id", "a", "b"])

    return docs.mapInArrow(run, "rid long, id long, a long, b long")


def _cut(docs: DataFrame, length: int) -> DataFrame:
    """(id, th, n_removed, cut_sha, spans) of documents whose ``known`` windows go."""
    span = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches("text", rows):
            w = words(texts, SPACED)
            raw, _ = text_bytes(texts)
            windows = w.sequences(w.hashes(), length)
            whole = w.whole(length)
            known, cut = _known(batch)
            removed, shas, spans = [], [], []
            for i in range(len(texts)):
                a, b = int(w.first[i]), int(w.first[i + 1])
                at = np.flatnonzero(whole[a:b] & np.isin(windows[a:b], known[cut[i] : cut[i + 1]]))
                change = np.zeros(b - a + 1, np.int64)
                change[at] += 1
                change[at + length] -= 1
                gone = np.cumsum(change)[:-1] > 0
                removed.append(int(gone.sum()))
                shas.append(_sha(raw, w.start[a:b][~gone], w.end[a:b][~gone]))
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                spans.append([{"first": int(x), "past": int(y)} for x, y in edge.reshape(-1, 2)])
            own = [pa.array(v, t) for v, t in zip((removed, shas, spans), (pa.int64(), pa.string(), span), strict=True)]
            keys = (batch.column(batch.schema.get_field_index(c)) for c in ("id", "th"))
            yield pa.RecordBatch.from_arrays([*keys, *own], ["id", "th", "n_removed", "cut_sha", "spans"])

    return docs.mapInArrow(run, "id long, th binary, n_removed long, cut_sha string, spans array<struct<first:long,past:long>>")


def repeated_passages(docs: DataFrame, length: int = LENGTH, levels: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What is left of each document when passages of documents with smaller ids go.

    A word goes if it lies in a window of ``length`` words that also starts in a
    document with a smaller id; windows are judged on the input. ``levels`` is the
    number of lengths looked at, each twice the one before; ``length`` must be
    divisible accordingly.

    One row a document: doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by one space) and spans, the removed stretches of words as [first, past).
    A null text has no words. A document without an id comes after all others, and
    two such have no order between them. Rows with the same id take nothing from each
    other. Rows come back as often as they came; extra columns are ignored; an empty
    table gives an empty result.
    """
    start = length >> (levels - 1)
    if levels < 2 or start << (levels - 1) != length or start < 1:
        raise ValueError("length must be a first length doubled once or more")
    base = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.unhex(F.md5(utf8(text))).alias("th"), F.col(text).alias("text"))
    scanned = staged(_scanned(base, start), "scanned")
    # Written down, as adaptive execution splits a hot key only between plain exchanges.
    classes = staged(scanned.groupBy("th").agg(F.min("id").alias("least")), "classes")

    speakers = classes.select("th", F.col("least").alias("id"))
    anchors = scanned.where(F.size("anchors") > 0).join(speakers, ["th", "id"]).select("id", "th", F.explode("anchors").alias("a"))
    twice = _repeated(anchors, "a")
    known = anchors.join(twice, "a").groupBy("id", "th").agg(F.collect_set("a").alias("known"))
    texts = base.join(known, ["id", "th"]).withColumn("rid", F.monotonically_increasing_id())
    texts = staged(texts, "candidates")  # the row numbers hold from here on

    size = 2 * start
    while True:
        found = _windows(texts, start, size)
        back = found.join(_repeated(found, "a", "b"), ["a", "b"])
        if size == length:
            back = back.where("id > least")
        known = back.groupBy("rid").agg(F.collect_list("a").alias("known"))
        texts = texts.drop("known").join(known, "rid")
        if size == length:
            break
        last, texts = texts, staged(texts, "survivors")
        discard(last)
        size *= 2

    cut = _cut(texts, length).dropDuplicates(["id", "th"])
    rows = scanned.drop("anchors").join(classes, "th").join(cut, ["id", "th"], "left")
    # A copy of a text that an earlier document has: all its windows, if it has any, start there.
    copied = F.col("id") > F.col("least")
    all_gone = copied & (F.col("n_words") >= length)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("past")))
    return rows.select(
        F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"),
        "n_words",
        F.when(all_gone, F.col("n_words")).when(copied, 0).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, F.lit(hashlib.sha256(b"").hexdigest())).when(copied, F.col("sha")).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        F.when(all_gone, everything).when(copied | F.col("spans").isNull(), F.array().cast("array<struct<first:long,past:long>>")).otherwise(F.col("spans")).alias("spans"),
    )
