"""Words and word-window hashes of whole Arrow string columns, in numpy.

A column is cut into slices of a few megabytes (one document at least), so the
working memory is a small multiple of ``SLICE_BYTES`` or of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000

_SPACE = bytes([0x20, *range(0x09, 0x0E)])


def _table(keep, lower: bool) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if lower and 0x41 <= b <= 0x5A else b
        if keep(c):
            out[b] = c or 255  # a NUL byte inside a word stays a word byte
    return out


#: Byte -> word byte, or 0 between words. UTF-8 keeps every byte of a character beyond ASCII at 0x80 or above.
SPACED = _table(lambda c: c not in _SPACE, lower=False)
SPACED_LOWER = _table(lambda c: c not in _SPACE, lower=True)
ALNUM_LOWER = _table(lambda c: c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A, lower=True)

_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[0] = 0
_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))  # odd, so they have inverses modulo 2^64


class _Powers:
    """Powers of an odd number modulo 2^64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.have = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.have) < n:
            by = np.uint64(pow(self.base, len(self.have), 1 << 64))
            self.have = np.concatenate([self.have, self.have * by])
        return self.have[:n]


_IN_WORD = _Powers(0xC2B2AE3D27D4EB4F)
_FORWARD = [_Powers(int(s)) for s in _STEP]
_BACK = [_Powers(pow(int(s), -1, 1 << 64)) for s in _STEP]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """The words of a run of documents.

    data: folded bytes, 0 between words; start, end: of each word in data;
    first: index of each document's first word, and the number of words at the end.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def joined(self, i: int, j: int) -> bytes:
        """Words i to j - 1, one space between them."""
        return b" ".join(self.data[self.start[i] : self.end[j - 1]].tobytes().replace(b"\0", b" ").split()) if j > i else b""

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        at = self.start[0]
        body = self.data[at:]
        lengths = np.diff(np.append(self.start, len(self.data)))
        place = np.arange(len(body), dtype=np.int64) - np.repeat(self.start - at, lengths)
        longest = int((self.end - self.start).max())
        np.minimum(place, longest - 1, out=place)
        h = np.add.reduceat(_BYTE[body] * _IN_WORD.upto(longest)[place], self.start - at)
        return mixed(h + (self.end - self.start).astype(np.uint64))

    def sequences(self, hashes: np.ndarray, k: int, which: int = 0) -> np.ndarray:
        """Hash of the k words from each word on; meaningless where fewer than k follow in the chunk."""
        n = len(hashes)
        if n < k:
            return np.zeros(n, np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _FORWARD[which].upto(n), out=total[1:])
        out = np.zeros(n, np.uint64)
        out[: n - k + 1] = mixed((total[k:] - total[: n - k + 1]) * _BACK[which].upto(n - k + 1))
        return out

    def whole(self, k: int) -> np.ndarray:
        """True for each word from which k words of the same document follow, itself included."""
        counts = np.diff(self.first)
        left = np.repeat(self.first[1:], counts) - np.arange(len(self.start))
        return left >= k


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text, one row at least."""
    offsets = _offsets(column)
    i, n = 0, len(column)
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one string array, null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def _offsets(column: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (and the last ends)."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(column)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, table: np.ndarray, kinds: np.ndarray | None = None) -> Words:
    """The words of a string column without nulls; ``table`` is one of the byte tables above.

    With ``kinds`` (1 or 2 for some bytes), a word is also cut between a byte of the one kind and one of the other.
    """
    raw, bounds = text_bytes(column)
    data = table[raw]
    inside = data != 0
    if not len(data):
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(column) + 1, np.int64))
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    cuts = None
    if kinds is not None:
        kind = kinds[raw]
        cuts = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
        cuts = cuts[(kind[cuts] > 0) & (kind[cuts - 1] > 0)]
        before[cuts] = False
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    if cuts is not None:
        after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, bounds)
    return Words(data, start, end, first)


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for count[0] values, then the next."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count - start, count)
