"""Row hashes that tell NULL positions apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_hash(columns: list[str], salt: str = "") -> Column:
    """64-bit hash of a row, columns in name order.

    ``xxhash64`` skips NULLs, so (NULL, 'a') and ('a', NULL) would collide; a
    NULL flag before every value keeps them apart.
    """
    parts: list[Column] = [F.lit(salt)]
    for c in sorted(columns):
        parts += [F.isnull(F.col(c)), F.col(c)]
    return F.xxhash64(*parts)
