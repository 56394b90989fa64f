"""Language identification with a string kernel.

Two texts are compared by the character n-grams (1 to 3) that both contain: the
blended-spectrum presence kernel, divided by the geometric mean of the sizes of the
two sets. N-grams are hashed into ``BUCKETS``. A few landmark texts stand for all
(Nystroem): a text's features are its kernel values with the landmarks, and one ridge
regression a language separates it from the rest. Texts are scored in batches: one
product with the landmarks' n-grams, one with the regressions' weights.

The model is fitted on a bounded sample (``SAMPLE`` texts in all, divided over all languages,
``PER_LANGUAGE`` of each at most and one at least, of a longer one ``LONGEST`` characters from its
first letter), drawn by a hash of the id; every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import batches, fresh_names

BUCKETS, ORDERS = 1 << 14, 3
LANDMARKS, RIDGE = 64, 0.05
#: Bounds of the training sample: texts (and so languages), texts a language, and characters of one.
SAMPLE, PER_LANGUAGE, LONGEST = 3000, 300, 20_000
#: Rows of one matrix product.
ROWS = 256
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def grams(text: str) -> np.ndarray:
    """True for the buckets of the n-grams that the lower-cased text contains."""
    seen = np.zeros(BUCKETS, bool)
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    h = np.zeros(len(c), np.uint64)
    for n in range(1, ORDERS + 1):
        if len(c) < n:
            break
        h = (h[: len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        seen[(h >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)] = True
    return seen


def presence(texts: list[str]) -> np.ndarray:
    """A row a text, scaled to length one, so that products of rows are kernel values."""
    out = np.empty((len(texts), BUCKETS), np.float32)
    for i, text in enumerate(texts):
        out[i] = grams(text)
    return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # buckets x landmarks
    weights: np.ndarray  # (landmarks + 1) x languages

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """A language (or ``und`` without letters or without a model) and a score from 0 to 1 each."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        some = [i for i, t in enumerate(texts) if self.languages and _LETTER.search(t)]
        for i in range(0, len(some), ROWS):
            part = some[i : i + ROWS]
            values = _features(presence([texts[j] for j in part]) @ self.landmarks) @ self.weights
            best = values.argmax(axis=1)
            for j, b, v in zip(part, best, values[np.arange(len(part)), best], strict=True):
                names[j] = self.languages[b]
                scores[j] = min(max((float(v) + 1) / 2, 0.0), 1.0)
        return names, scores


def _features(kernel: np.ndarray) -> np.ndarray:
    return np.concatenate([kernel, np.ones((len(kernel), 1), kernel.dtype)], axis=1).astype(np.float64)


def fit(texts: list[str], languages: list[str], seed: int = 0) -> Model:
    """Kernel ridge regression, one language against the rest, on Nystroem features.

    Besides each whole text, two short pieces of it are examples, as short texts are
    to be told as well. Landmarks are drawn from the whole texts, as many of each language.
    """
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((1, 0)))
    rng = np.random.default_rng(seed)
    chosen: list[int] = []
    for name in names:
        own = [i for i, lang in enumerate(languages) if lang == name]
        chosen += rng.permutation(own)[: max(1, LANDMARKS // len(names))].tolist()
    if len(chosen) > LANDMARKS:  # more languages than landmarks: some stand for the others
        chosen = sorted(rng.permutation(chosen)[:LANDMARKS].tolist())
    landmarks = presence([texts[i] for i in chosen])
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T

    examples, wanted = [], []
    for text, name in zip(texts, languages, strict=True):
        pieces = [text]
        for size in (40, 150):
            if len(text) > 2 * size:
                at = int(rng.integers(0, len(text) - size))
                pieces.append(text[at : at + size])
        pieces = [p for p in pieces if _LETTER.search(p)]
        examples += pieces
        wanted += [names.index(name)] * len(pieces)
    kernel = [presence(examples[i : i + ROWS]) @ landmarks.T for i in range(0, len(examples), ROWS)]
    features = _features(np.concatenate([k @ whiten for k in kernel]) if kernel else np.zeros((0, len(chosen))))
    target = -np.ones((len(examples), len(names)))
    target[np.arange(len(examples)), wanted] = 1
    ridge = RIDGE * np.eye(features.shape[1])
    ridge[-1, -1] = 1e-6
    solved = np.linalg.solve(features.T @ features + ridge, features.T @ target)
    return Model(names, np.ascontiguousarray(landmarks.T), np.concatenate([whiten @ solved[:-1], solved[-1:]]))


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids, by checksum; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on labelled rows that have an id and are not held out.

    At most twice ``SAMPLE`` rows come to the driver: a language's rows are drawn by a hash of the id, at
    the rate that gives its share. Rows with one id and language count once. Of more than ``SAMPLE``
    languages, the most frequent ones are learned.
    """
    usable = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & ~held_out(F.col("doc_id")))
    piece = F.regexp_extract("text", rf"\p{{L}}[\s\S]{{0,{LONGEST - 1}}}", 0)
    usable = usable.withColumn("text", F.when(F.char_length("text") <= LONGEST, F.col("text")).otherwise(piece)).where(F.char_length("text") > 0)
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE).collect()
    if not counts:
        return fit([], [])
    share = min(PER_LANGUAGE, max(1, SAMPLE // len(counts)))
    # The hash as a fraction, below the rate; a fifth more than wanted, then cut.
    rates = F.create_map(*(F.lit(x) for r in counts for x in (r.lang, min(1.0, 1.2 * share / r["count"]))))
    place = (F.xxhash64(F.col("doc_id").cast("string")).cast("double") / F.lit(2.0**64) + 0.5).alias("place")
    rows = usable.withColumn("place", place).where(F.col("place") < F.element_at(rates, F.col("lang")))
    rows = rows.groupBy("lang", "place", "doc_id").agg(F.min("text").alias("text"))
    drawn = rows.orderBy("place", "doc_id", "text").limit(2 * share * len(counts)).collect()
    taken: dict[str, int] = {}
    kept = []
    for r in drawn:
        taken[r.lang] = taken.get(r.lang, 0) + 1
        if taken[r.lang] <= share and _LETTER.search(r.text):
            kept.append(r)
    return fit([r.text for r in kept], [r.lang for r in kept])


def identified(docs: DataFrame, model: Model, columns: list[str] | None = None, text: str = "text", names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """``columns`` of the documents (all by default), the predicted language and its score.

    The prediction sees the text alone. A text that is null or has no letter is
    ``und`` with score 0. Rows come back as often as they came; a column that bears
    one of ``names`` is replaced. A third name adds whether the text has a letter.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in {n.lower() for n in names}]
    schema = docs.select(*columns).schema.add(names[0], "string").add(names[1], "double")
    for name in names[2:]:
        schema = schema.add(name, "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS x LANDMARKS

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(text, rows):
            found, scores = shared.value.predict(texts.to_pylist())
            own = [pa.array(found, pa.string()), pa.array(scores)]
            own += [pa.array([bool(_LETTER.search(t)) for t in texts.to_pylist()], pa.bool_()) for _ in names[2:]]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in columns), *own], [*columns, *names])

    return docs.select(*dict.fromkeys([*columns, text])).mapInArrow(run, schema)


def with_language(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents with a letter, all columns: those that a model, if there is one, gives a language.

    A document that bears no language gets the predicted one in ``lang``, if the table has that column
    and the model a language for it.
    """
    names = tuple(fresh_names(docs, "lang_pred", "score", "letter"))
    kept = identified(docs, model, text=text, names=names).where(F.col(names[2]))
    if lang not in docs.columns:
        return kept.select(*docs.columns)
    told = F.coalesce(F.col(lang), F.when(F.col(names[0]) != UNKNOWN, F.col(names[0]))).cast(docs.schema[lang].dataType)
    return kept.select(*(told.alias(c) if c == lang else F.col(c) for c in docs.columns))
