"""Where a pattern matches in a text, with built-in functions only.

Spark returns the matches of a pattern and the pieces between them, but no places.
The two lists alternate, so running lengths give the places in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.llm.common import let

SPAN = "array<struct<start:int,past:int,text:string>>"
#: A fold that builds a list copies it at each step, so long lists are built in blocks.
BLOCK = 256


def running(values: Column, first: Column, op) -> Column:
    """For each value, what ``op`` makes of ``first`` and the values before it. The work is linear in
    the values as long as they are fewer than some millions."""

    def scan(xs: Column, start: Column) -> Column:
        none = F.slice(F.array(first), 1, 0)
        step = lambda s, x: F.struct(op(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(xs, F.struct(start.alias("at"), none.alias("out")), step, lambda s: s["out"])

    def blocks(of: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(of) / BLOCK).cast("int")), lambda b: F.slice(of, b * BLOCK + 1, BLOCK))

    def over(found: Column) -> Column:
        begins = scan(F.transform(found, lambda xs: F.aggregate(xs, first, lambda a, x: op(a, x))), first)
        return F.flatten(F.zip_with(found, begins, scan))

    return let(blocks(values), over)


def matches(text: Column, pattern: Column) -> Column:
    """All leftmost non-overlapping matches as (start, past, text), in order. The pattern matches no empty text."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    steps = F.zip_with(pieces, found, lambda a, b: F.struct(F.coalesce(F.char_length(a), F.lit(0)).alias("gap"), F.char_length(b).alias("n"), b.alias("text")))
    steps = F.filter(steps, lambda s: s["n"].isNotNull())

    def placed(steps: Column) -> Column:
        at = running(F.transform(steps, lambda s: s["gap"] + s["n"]), F.lit(0), lambda a, x: a + x)
        return F.zip_with(steps, at, lambda s, a: F.struct((a + s["gap"]).alias("start"), (a + s["gap"] + s["n"]).alias("past"), s["text"].alias("text")))

    return F.when(F.size(found) > 0, let(steps, placed)).otherwise(F.array().cast(SPAN))


def between(text: Column, pattern: Column) -> Column:
    """What lies before, between and behind the matches of a pattern as (start, past, text), in order; some of it may be empty."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    steps = F.zip_with(F.split(text, pattern, -1), found, lambda a, b: F.struct(a.alias("text"), F.char_length(a).alias("n"), F.coalesce(F.char_length(b), F.lit(0)).alias("gap")))

    def placed(steps: Column) -> Column:
        at = running(F.transform(steps, lambda s: s["n"] + s["gap"]), F.lit(0), lambda a, x: a + x)
        return F.zip_with(steps, at, lambda s, a: F.struct(a.alias("start"), (a + s["n"]).alias("past"), s["text"].alias("text")))

    return let(steps, placed)


def joined(stretches: Column) -> Column:
    """Sorted (first, past) stretches with growing ends, those that touch or overlap made one."""
    begins = F.filter(stretches, lambda s, i: (i == 0) | (s["first"] > F.get(stretches, i - 1)["past"]))
    ends = F.filter(stretches, lambda s, i: F.get(stretches, i + 1).isNull() | (F.get(stretches, i + 1)["first"] > s["past"]))
    return F.zip_with(begins, ends, lambda a, b: F.struct(a["first"].alias("first"), b["past"].alias("past")))
