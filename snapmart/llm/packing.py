"""Packing token sequences of a fixed size by sums of squares.

Documents become pieces of at most ``size`` tokens. A piece goes where it leaves the
sum of squares of the numbers of open sequences per residual gap smallest: into an open
sequence of some gap, or into a new one. So no gap grows common that nothing fills.

The pieces are dealt at random over groups of bounded size, each packed by one task
in decreasing order; a group leaves a few sequences partly empty, whatever its size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import batches, staged
from snapmart.llm.tokenization import tokenizer

SIZE, END = 4096, 1
#: Pieces of one group, about.
GROUP = 50_000


def sum_of_squares(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, taken in the order given.

    Moving a sequence from gap g to g - n changes the sum of squares by
    2 * (N[g - n] - N[g] + 1), closing one by 1 - 2 * N[g], a new one by
    1 + 2 * N[size - n]. Gap 0 is not counted. Of equal changes, the smallest gap wins.
    """
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    number = np.zeros(size + 1, np.int64)
    gap_of: list[int] = []
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    barred = np.int64(1) << 60
    for i, n in enumerate(lengths.tolist()):
        change = 2 * (number[: size - n] - number[n:size] + 1)
        if n < size:
            change[0] = 1 - 2 * number[n]
        change = np.where(number[n:size] > 0, change, barred)
        best = int(change.argmin()) if len(change) else -1
        fresh = 1 + 2 * number[size - n] if n < size else 0
        if best < 0 or change[best] > fresh:
            at, gap = len(gap_of), size
            gap_of.append(size)
        else:
            gap = best + n
            at = open_at[gap].pop()
            number[gap] -= 1
        sequence[i], offset[i] = at, size - gap
        rest = gap - n
        gap_of[at] = rest
        if rest:
            open_at[rest].append(at)
            number[rest] += 1
    return sequence, offset


def pieces(docs: DataFrame, path: str, size: int = SIZE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each text and the end id, cut where longer than ``size``.

    A null or empty text is the end id alone.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer(path)
        for batch, texts in batches("text", rows):
            ids, cut = known.encode(texts)
            doc, piece, start, length, crc = [], [], [], [], []
            for i in range(len(texts)):
                own = np.append(ids[cut[i] : cut[i + 1]], END).astype("<u4")
                for p, at in enumerate(range(0, len(own), size)):
                    part = own[at : at + size]
                    doc.append(i)
                    piece.append(p)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            names = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(doc, pa.int64()))
            rest = (pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc)))
            yield pa.RecordBatch.from_arrays([names, *rest], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = rows.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    return rows.mapInArrow(run, schema)


def packed(docs: DataFrame, path: str, size: int = SIZE, group: int = GROUP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents, each with its sequence and its place there.

    ``path`` is the tokenizer's file, which every machine has. Every piece is placed,
    repeated rows as often as they come; a row without an id keeps null. Sequence
    numbers are unique; offsets in a sequence begin at 0 and have no gaps. An empty
    table has no sequences. Extra columns are ignored.
    """
    cut = staged(pieces(docs, path, size, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-cut.count() // group))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row"], ascending=[False, True])
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), size)
        rows = rows.assign(sequence_id=key[0] * (1 << 40) + sequence, offset=offset)
        return rows[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    schema = cut.select("doc_id", "piece", "start", "length", "ids_crc32").schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("part").applyInPandas(pack, schema)
