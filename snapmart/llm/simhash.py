"""SimHash near-duplicates, found with a pigeonring filter.

A fingerprint is a ring of four 16-bit segments. If two fingerprints differ in at
most 3 bits, some segment begins a chain in which each prefix of l segments
differs in at most l * 3 / 4 bits, rounded down: 0 in the first, 1 in the first
two, 2 in three, 3 in four. The first two links are the join key: the first
segment exactly, the second up to one cleared bit. The third prunes what the join
finds, the fourth is the full Hamming check.

Copies never meet: the join is between distinct fingerprints. Buckets whose
fingerprints are many (a dense group of near copies) are joined by the next
segment as well, see ``links``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import batches, fresh_names, staged
from snapmart.llm.components import components
from snapmart.sources.staging import discard

BITS, SEGMENTS = 64, 4
WIDTH = BITS // SEGMENTS
SEED = 42

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingles(text: bytes, k: int) -> list[bytes]:
    """The k-word shingles of a text, A-Z folded; fewer words are one shingle, none are none."""
    words = text.translate(_LOWER).split()
    if len(words) < k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def fingerprints(texts: list[bytes], k: int) -> np.ndarray:
    """The 64-bit SimHash of each text as a signed number; no words: 0."""
    counts = np.zeros(len(texts), np.int64)
    parts = []
    for i, text in enumerate(texts):
        grams = shingles(text, k)
        counts[i] = len(grams)
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(grams)))
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        # One row of 64 columns a shingle, the highest bit first; a text's rows stand together.
        bits = np.unpackbits(np.concatenate(parts).astype(">u8").view(np.uint8)).reshape(-1, BITS)
        first = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.uint32)
        majority = 2 * ones > counts[some][:, None]
        out[some] = np.packbits(majority, axis=1).view(">u8").ravel().astype(np.uint64)
    return out.view(np.int64)


def with_fingerprint(docs: DataFrame, k: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The rows without their text, and their fingerprint as a long."""
    kept = [c for c in docs.columns if c != text]
    schema = docs.select(*kept).schema.add(name, "long")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(text, rows):
            found = fingerprints([t.as_buffer().to_pybytes() for t in texts.cast(pa.binary())], k)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(found)], [*kept, name])

    return docs.mapInArrow(run, schema)


def hex16(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


# ---- links ------------------------------------------------------------------------

def _segment(fp: Column, i: int) -> Column:
    """Segment i of the ring, counted from the low end."""
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _pair(s0: str, s1: str) -> Column:
    return F.shiftleft(F.col(s0), WIDTH).bitwiseOR(F.col(s1))


def _masks(bits: int) -> list[int]:
    """The segment values with at most so many bits set."""
    return [sum(1 << b for b in chosen) for n in range(bits + 1) for chosen in combinations(range(WIDTH), n)]


def _chain_mask(i: int, length: int) -> int:
    """The bits of ``length`` segments from segment i on, as a signed number."""
    mask = sum(((1 << WIDTH) - 1) << (WIDTH * ((i + j) % SEGMENTS)) for j in range(length))
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(distinct: DataFrame, distance: int = 3, crowded: int = 1000) -> DataFrame:
    """All pairs (a, b) of different fingerprints ``fp`` at ``distance`` bits or fewer, some more than once.

    Two rows meet if they agree in a segment and differ in the next by no more than
    the chain allows (one bit); of two values a bit apart, the one with the bit set
    clears it, so a fingerprint makes about nine rows a segment. Buckets with more
    than ``crowded`` fingerprints are joined by the third segment too, within its
    budget. Either way is complete: no bucket is cut. The joins are merge joins by
    hint: Spark takes the rows for as few as the fingerprints they come from.
    """
    if not 0 <= distance < SEGMENTS:
        raise ValueError(f"distance must be below {SEGMENTS}, the number of segments")
    budget = [length * distance // SEGMENTS for length in range(SEGMENTS + 1)]
    fp = F.col("fp")
    starts = [F.struct(F.lit(i).alias("i"), *(_segment(fp, i + j).alias(f"s{j}") for j in range(3))) for i in range(SEGMENTS)]
    own = distinct.select("fp", F.inline(F.array(*starts))).withColumn("key", _pair("s0", "s1"))
    set_masks = F.filter(F.array(*map(F.lit, _masks(budget[2]))), lambda m: F.col("s1").bitwiseAND(m) == m)
    near = own.select("fp", "i", "s0", "s2", F.explode(F.transform(set_masks, lambda m: F.col("s1").bitwiseXOR(m))).alias("s1"))
    x = own.select("i", "key", "s2", F.col("fp").alias("x"))
    y = near.select("i", _pair("s0", "s1").alias("key"), "s2", F.col("fp").alias("y"))

    full = staged(own.groupBy("i", "key").count().where(F.col("count") > crowded).select("i", "key"), "crowded")
    if full.isEmpty():
        discard(full)
        return _checked(x.hint("merge").join(y, ["i", "key"]), distance, budget)
    flips = F.transform(F.array(*map(F.lit, _masks(budget[3]))), lambda m: F.col("s2").bitwiseXOR(m))
    dense = y.join(full, ["i", "key"], "left_semi").withColumn("s2", F.explode(flips))
    sparse = x.join(full, ["i", "key"], "left_anti").hint("merge").join(y, ["i", "key"])
    crossed = x.join(full, ["i", "key"], "left_semi").hint("merge").join(dense, ["i", "key", "s2"])
    return _checked(sparse, distance, budget).unionByName(_checked(crossed, distance, budget))


def _checked(pairs: DataFrame, distance: int, budget: list[int]) -> DataFrame:
    """Pairs within the budget of three segments, then of the whole ring."""
    differ = F.col("x").bitwiseXOR(F.col("y"))
    chain = F.element_at(F.array(*(F.lit(_chain_mask(i, 3)) for i in range(SEGMENTS))), F.col("i") + 1)
    kept = (F.col("x") != F.col("y")) & (F.bit_count(differ.bitwiseAND(chain)) <= budget[3]) & (F.bit_count(differ) <= distance)
    return pairs.where(kept).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


# ---- groups -----------------------------------------------------------------------

def near_groups(docs: DataFrame, k: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text", crowded: int = 1000) -> DataFrame:
    """One row a document: ``doc_id``, ``fp`` (long), ``root`` and ``component_id``.

    ``root`` is the least fingerprint of the component. ``component_id`` is the smallest doc_id whose fingerprint is reachable over
    links of at most ``distance`` bits. A null or empty text, or one of white space
    alone, has fingerprint 0 and is linked like any other. A null doc_id keeps its
    row and never names a component that has another id; repeated rows come back as
    often as they came. An empty table gives an empty result. Extra columns are
    ignored.
    """
    prints = staged(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), k, "text", "fp"), "fingerprints")
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    parts = components(links(distinct, distance, crowded))
    nodes = staged(parts.select(F.col("node").alias("fp"), "root").unionByName(parts.select(F.col("root").alias("fp"), "root").distinct()), "nodes")
    roots = nodes.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("named"))
    linked = nodes.join(roots, "root")
    named = distinct.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("named", "least").alias("component_id"))
    named = staged(named, "named")
    for done in (nodes, parts, distinct):
        discard(done)
    return prints.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, k: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns: one document of each group, the one that names it.

    Of rows that share the naming doc_id (or have none) in a group, one stays.
    """
    group, times, key, copy = fresh_names(docs, "component", "times", "key", "copy")
    found = staged(near_groups(docs, k, distance, doc_id, text), "groups")
    names = F.col("component_id").eqNullSafe(F.col("doc_id"))
    ids = found.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias(times), F.max(names).alias(copy))
    rows = docs.join(ids.where(F.col(copy)).drop(copy), docs[doc_id] == F.col(key)).drop(key)
    # An id that several rows have, whether they stay or not, does not tell them apart, nor does none; for those, the fingerprint is computed anew.
    unsure = rows.where(F.col(times) > 1).select(*docs.columns).unionByName(docs.where(F.col(doc_id).isNull()))
    several = with_fingerprint(unsure.withColumn(copy, F.col(text)), k, copy, key)
    groups = found.where(names).select(F.col("fp").alias(key), F.col("root").alias(group), F.col("component_id").alias(copy)).distinct()
    several = several.join(groups, key).where(F.col(copy).eqNullSafe(F.col(doc_id))).dropDuplicates([group])
    return rows.where(F.col(times) == 1).select(*docs.columns).unionByName(several.select(*docs.columns))
