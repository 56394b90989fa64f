"""Quality scores by a factorisation machine.

A document is a sparse vector: the hashed lower-cased words it has (scaled to length
one), and one feature for the interval that each of its structure statistics and
metadata columns falls into (scaled to length one together). The score is

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

through a sigmoid. The pairs are never listed: with ``FACTORS`` columns f their sum is
half of sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2), linear in the features.

The model is fitted on a bounded sample, ``SAMPLE`` labelled documents of either label,
drawn by a hash of the id; their features, not their texts, come to the driver, at most
``WIDTH`` numbers a document. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import batches, fresh_names
from snapmart.llm.textkernel import ALNUM_LOWER, SPACED_LOWER, text_bytes, words

#: Buckets of the hashed words; intervals of a statistic or a metadata column; the last one stands for "none".
WORDS, BINS = 1 << 13, 24
FACTORS, EPOCHS, BATCH, RATE, RIDGE = 8, 12, 128, 0.1, 1e-4
#: Bound of the training sample: documents of either label.
SAMPLE = 2000
STATISTICS = 13
WIDTH = WORDS + (STATISTICS + 8) * BINS

_LINES = np.ones(256, np.uint8)
_LINES[ord("\n")] = 0


def _class(keep) -> np.ndarray:
    return np.array([keep(b) for b in range(256)])


_UPPER = _class(lambda b: 0x41 <= b <= 0x5A)
_LOWER = _class(lambda b: 0x61 <= b <= 0x7A)
_DIGIT = _class(lambda b: 0x30 <= b <= 0x39)
_STOP = _class(lambda b: b in b".!?")
_SYMBOL = _class(lambda b: b in b"#*$%&|<>{}[]\\^~=+_@")
_WIDE = _class(lambda b: b >= 0xC0)
_SPACE = _class(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)


def _distinct(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (document, value) pairs, by document, and their number a document."""
    if not len(doc):
        return doc, value, np.zeros(n, np.int64)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.append(True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1]))
    return doc[first], value[first], np.bincount(doc[first], minlength=n)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Interval of a share: a square-root scale, finer for small shares; none where there is no whole."""
    bins = np.minimum(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)) * (BINS - 1), BINS - 2)
    return np.where(whole > 0, bins, BINS - 1).astype(np.int64)


def _size(n: np.ndarray) -> np.ndarray:
    """Interval of a count: by powers of two."""
    return np.minimum(np.log2(np.maximum(n, 0) + 1), BINS - 2).astype(np.int64)


@dataclass
class Features:
    """Sparse rows: row r has the features index[first[r]:first[r + 1]], with these values."""

    index: np.ndarray
    value: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def features(texts: pa.Array, metadata: list[np.ndarray]) -> Features:
    """The features of a run of texts. ``metadata`` has an interval (0 to BINS - 1) a text and column."""
    n = len(texts)
    found = words(texts, SPACED_LOWER)
    n_words = np.diff(found.first)
    doc = np.repeat(np.arange(n), n_words)
    hashes = found.hashes()
    _, _, n_types = _distinct(doc, hashes, n)
    again = np.bincount(doc[1:][(hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    owner, bucket, per_doc = _distinct(doc, (hashes >> np.uint64(40)).astype(np.int64) & (WORDS - 1), n)
    lines = words(texts, _LINES)
    n_lines = np.diff(lines.first)
    _, _, line_types = _distinct(np.repeat(np.arange(n), n_lines), lines.hashes(), n)
    plain = np.diff(words(texts, ALNUM_LOWER).first)

    data, bounds = text_bytes(texts)

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=sums[1:])
        return np.diff(sums[bounds])

    size = np.diff(bounds)
    upper, lower, wide, solid = count(_UPPER), count(_LOWER), count(_WIDE), size - count(_SPACE)
    intervals = [
        _size(n_words),
        np.where(n_words > 0, np.minimum(solid / np.maximum(n_words, 1), BINS - 2), BINS - 1).astype(np.int64),
        _share(upper, upper + lower),
        _share(upper + lower + wide, solid),
        _share(count(_DIGIT), solid),
        _share(count(_SYMBOL), solid),
        _share(count(_STOP), n_words),
        _share(n_words - n_types, n_words),
        _share(again, n_words),
        _share(n_lines - line_types, n_lines),
        _share(n_lines, n_words),
        _share(plain, np.maximum(n_words * 2, plain)),
        _size(size),
        *metadata,
    ]
    dense = np.stack(intervals, axis=1) + WORDS + np.arange(len(intervals)) * BINS
    width = dense.shape[1]
    first = np.append(0, np.cumsum(per_doc + width))
    index, value = np.empty(first[-1], np.int64), np.empty(first[-1])
    own = first[:-1, None] + np.arange(width)
    index[own], value[own] = dense, 1 / np.sqrt(width)
    at = np.arange(len(owner)) + (owner + 1) * width
    index[at], value[at] = bucket, 1 / np.sqrt(per_doc[owner])
    return Features(index, value, first)


@dataclass
class Model:
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((WIDTH, FACTORS)))

    def margin(self, x: Features) -> tuple[np.ndarray, np.ndarray]:
        """The value before the sigmoid, and sum_i v_i x_i, a row each. Every row has a feature."""
        part = self.factors[x.index] * x.value[:, None]
        linear = np.add.reduceat(self.weights[x.index] * x.value, x.first[:-1])
        sums = np.add.reduceat(part, x.first[:-1], axis=0)
        squares = np.add.reduceat((part * part).sum(axis=1), x.first[:-1])
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, x: Features) -> np.ndarray:
        return sigmoid(self.margin(x)[0]) if len(x.first) > 1 else np.zeros(0)


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 0) -> Model:
    """Logistic loss, adaptive steps over ``EPOCHS`` passes in a fixed random order; both labels weigh
    the same. Without rows every score is one half."""
    model = Model()
    if not rows:
        return model
    rng = np.random.default_rng(seed)
    model.factors = rng.normal(0, 0.05, (WIDTH, FACTORS))
    target = np.array(labels, float)
    good = target.sum()
    weight = np.where(target > 0, len(target) / (2 * max(good, 1)), len(target) / (2 * max(len(target) - good, 1)))
    seen = [np.full(1, 1e-6), np.full(WIDTH, 1e-6), np.full((WIDTH, FACTORS), 1e-6)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            x = Features(
                np.concatenate([rows[j][0] for j in some]), np.concatenate([rows[j][1] for j in some]),
                np.append(0, np.cumsum([len(rows[j][0]) for j in some])),
            )
            margin, sums = model.margin(x)
            error = (sigmoid(margin) - target[some]) * weight[some] / len(some)
            row = x.rows()
            touched, place = np.unique(x.index, return_inverse=True)
            pull = error[row] * x.value
            flat = np.bincount(place, pull) + RIDGE * model.weights[touched]
            steep = np.stack(
                [np.bincount(place, pull * (sums[row, f] - model.factors[x.index, f] * x.value)) for f in range(FACTORS)], axis=1
            ) + RIDGE * model.factors[touched]
            seen[0] += error.sum() ** 2
            seen[1][touched] += flat**2
            seen[2][touched] += steep**2
            model.bias -= RATE * float(error.sum() / np.sqrt(seen[0][0]))
            model.weights[touched] -= RATE * flat / np.sqrt(seen[1][touched])
            model.factors[touched] -= RATE * steep / np.sqrt(seen[2][touched])
    return model


def held_out(doc_id: Column) -> Column:
    """A third of the ids, by checksum; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _interval(column: Column, kind: str) -> Column:
    """A metadata value's interval: numbers by powers of two (negative ones with 0), others by hash; null is the last one."""
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        number = column.cast("double")
        found = F.least(F.floor(F.log2(F.greatest(F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0)), F.lit(0.0)) + 1)), F.lit(BINS - 2))
    else:
        found = F.pmod(F.xxhash64(column.cast("string")), F.lit(BINS - 1))
    return F.when(column.isNull(), BINS - 1).otherwise(found).cast("int")


def _prepared(docs: DataFrame, columns: list[str], text: str, metadata: list[str]) -> tuple[DataFrame, list[str]]:
    if len(metadata) > 8:
        raise ValueError("at most eight metadata columns")
    names = fresh_names(docs, *("interval" for _ in metadata)) if metadata else []
    kinds = dict(docs.dtypes)
    wanted = list(dict.fromkeys([*columns, text]))
    return docs.select(*wanted, *(_interval(F.col(c), kinds[c]).alias(n) for c, n in zip(metadata, names, strict=True))), names


def _of_batch(batch: pa.RecordBatch, texts: pa.Array, names: list[str]) -> Features:
    return features(texts, [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", metadata: list[str] | None = None) -> Model:
    """Fit on documents whose id is labelled 0 or 1 and not held out.

    An id that bears both labels, none or no id teaches nothing; repeated labels count
    once, and of several documents with one id the one with the least features is
    taken. ``metadata`` are columns of the documents.
    """
    marks = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_label"))
    marks = marks.where(F.col("_id").isNotNull() & F.col("_label").isin(0.0, 1.0) & ~held_out(F.col("_id")))
    marks = marks.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most")).where("_label = _most")
    counts = {r._label: r["count"] for r in marks.groupBy("_label").count().collect()}
    # The hash of the id as a fraction, below the rate that gives a label its share.
    place = F.xxhash64(F.col("_id").cast("string")).cast("double") / F.lit(2.0**64) + 0.5
    rate = F.when(F.col("_label") == 1, min(1.0, SAMPLE / counts.get(1.0, 1))).otherwise(min(1.0, SAMPLE / counts.get(0.0, 1)))
    drawn = marks.withColumn("_place", place).where(F.col("_place") < rate).orderBy("_place", "_id").limit(2 * SAMPLE).select("_id", "_label", "_place")

    rows, names = _prepared(docs, [doc_id], text, metadata or [])
    rows = rows.join(F.broadcast(drawn), F.col(doc_id) == F.col("_id"))  # at most 2 * SAMPLE small rows

    def run(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(text, part):
            x = _of_batch(batch, texts, names)
            pieces = [x.index[i:j].astype(np.int32).tobytes() for i, j in zip(x.first[:-1], x.first[1:], strict=True)]
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("_place", "_id", "_label")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(pieces, pa.binary())], ["_place", "_id", "_label", "_index"])

    kind = dict(drawn.dtypes)["_id"]
    got = rows.mapInArrow(run, f"_place double, _id {kind}, _label double, _index binary")
    got = got.groupBy("_place", "_id").agg(F.min(F.struct("_index", "_label")).alias("x")).collect()
    width = STATISTICS + len(names)
    sample, wanted = [], []
    for r in sorted(got, key=lambda r: (r._place, str(r._id))):
        index = np.frombuffer(r.x._index, np.int32).astype(np.int64)
        value = np.full(len(index), 1 / np.sqrt(max(len(index) - width, 1)))
        value[:width] = 1 / np.sqrt(width)
        sample.append((index, value))
        wanted.append(int(r.x._label))
    return fit(sample, wanted)


def scored(docs: DataFrame, model: Model, columns: list[str] | None = None, text: str = "text", metadata: list[str] | None = None, name: str = "score") -> DataFrame:
    """``columns`` of the documents (all by default) and the score, 0 to 1, higher where label 1 is likelier.

    The score sees the text and the ``metadata`` columns, which must be those of the
    training. A null text is read as the empty one, which has a score as well. Rows come
    back as often as they came; a column that bears ``name`` is replaced.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() != name.lower()]
    rows, names = _prepared(docs, columns, text, metadata or [])
    schema = docs.select(*columns).schema.add(name, "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH x (FACTORS + 1) numbers

    def run(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(text, part):
            found = pa.array(shared.value.score(_of_batch(batch, texts, names)), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in columns), found], [*columns, name])

    return rows.mapInArrow(run, schema)
