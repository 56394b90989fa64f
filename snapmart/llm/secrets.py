"""Secrets in texts: three patterns, and character runs of high entropy.

A candidate is a run of token characters. A window slides over it; the counts of
the class's characters change by one in and one out, and with them the sum of
c * log2(c), from which the entropy of the window follows. What windows above the
class's threshold cover is secret: each stretch of such windows that touch or overlap is a
span, unless it lies inside a match of the patterns. What the allow-list excuses is cut
out of a candidate, and the pieces left are candidates of their own. Built-in
functions only; texts without a match pass a pattern test and nothing else. The work is
linear in the length of a text and in the number of its matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import fresh_names, let
from snapmart.llm.spans import SPAN, between, joined, matches, running


@dataclass(frozen=True)
class Pattern:
    """A kind of match; ``valid`` tells which matches stay."""

    kind: str
    regex: str
    valid: str


#: In the order in which spans with the same start are listed.
PATTERNS = (
    Pattern(
        "assign",
        r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        r"""^(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}$""",
    ),
    Pattern("access", r"AKIA[A-Z0-9]+", r"^.{18,}$"),
    # Runs of at least 16: the shorter ones fail, and as runs end where the class ends they hide no longer one.
    Pattern("hex", r"[0-9a-f]{16,}", r"^.{16,}$"),
)


@dataclass(frozen=True)
class CharacterClass:
    """Candidates that match ``regex`` whole; characters of ``alphabet`` are counted, after folding if it says so."""

    kind: str
    regex: str
    alphabet: str
    window: int
    bits: float
    fold: bool = False


CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: The first class that matches a candidate is the one used.
CLASSES = (
    CharacterClass("entropy_hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", "0123456789abcdef", 20, 2.9, fold=True),
    CharacterClass("entropy_token", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", 20, 3.9),
)
#: What is no secret whatever its entropy: the last one excuses a candidate as a whole, of the others see ``EXCUSED``.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]",
    r"(?i)0123456789|abcdefghij",
    r"(.)\1{7}",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
#: Letters and digits on either side of a listed word that belong to it. It is a policy, not a bound on the work: a
#: made-up key is as long as a real one, 64 characters at most; what goes on beyond that is judged like any other candidate.
NEAR = 64
#: What the others excuse: a run of one character; a listed word or sequence, ``NEAR`` letters and digits next to it and what sets them off.
EXCUSED = rf"(.)\1{{7,}}|[/=_-]?[A-Za-z0-9]{{0,{NEAR}}}(?i:example|sample|dummy|placeholder|changeme|your[_-]|0123456789|abcdefghij)[A-Za-z0-9]{{0,{NEAR}}}[/=_-]?"
KINDS = [p.kind for p in PATTERNS] + [c.kind for c in CLASSES]
SPANS = "array<struct<start:int,rank:int,past:int,kind:string>>"


def _span(start: Column, past: Column, kind: str) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), past.alias("past"), F.lit(kind).alias("kind"))


#: Characters of a candidate that one fold goes over; neighbouring folds share a window less one.
STRIDE = 1000


def _stretches(candidate: Column, cls: CharacterClass) -> Column:
    """The (first, past) stretches of a candidate that windows above the threshold cover, in characters of it."""
    size = len(cls.alphabet)
    log = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(cls.window + 2)))
    # Sum of c * log2(c) at the threshold; a lower sum is a higher entropy.
    limit = cls.window * (math.log2(cls.window) - cls.bits) + 1e-9
    text = F.lower(candidate) if cls.fold else candidate
    codes = F.transform(F.split(text, ""), lambda c: F.call_function("locate", c, F.lit(cls.alphabet)))

    def parts(codes: Column) -> Column:
        begins = F.sequence(F.lit(0), F.floor((F.size(codes) - 1) / STRIDE).cast("int"))
        found = F.transform(begins, lambda b: F.transform(
            _slide(F.slice(codes, b * STRIDE + 1, STRIDE + cls.window - 1), size, cls.window, log, limit),
            lambda s: F.struct((s["first"] + b * STRIDE).alias("first"), (s["past"] + b * STRIDE).alias("past")),
        ))
        return let(F.flatten(found), joined)

    return let(codes, parts)


def _slide(codes: Column, size: int, window: int, log: Column, limit: float) -> Column:
    """The stretches of one fold: closed ones in a list, the one that may go on beside it."""
    none = F.array().cast("array<struct<first:int,past:int>>")
    zero = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("at"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("past"), none.alias("closed"),
    )
    leaving = F.concat(F.array_repeat(F.lit(0), window), codes)
    moves = F.zip_with(codes, F.slice(leaving, 1, F.size(codes)), lambda i, o: F.struct(i.alias("i"), o.alias("o")))
    own = lambda s: F.array(F.struct(s["first"].alias("first"), s["past"].alias("past")))

    def step(s: Column, m: Column) -> Column:
        entered = F.get(s["counts"], m["i"] - 1)
        counts = F.transform(s["counts"], lambda c, k: c + F.when(k == m["i"] - 1, 1).otherwise(0) - F.when(k == m["o"] - 1, 1).otherwise(0))
        left = F.when(m["o"] > 0, F.get(s["counts"], m["o"] - 1) + F.when(m["o"] == m["i"], 1).otherwise(0))
        total = s["sum"] + F.get(log, entered + 1) - F.get(log, entered) + F.coalesce(F.get(log, left - 1) - F.get(log, left), F.lit(0.0))

        def moved(total: Column) -> Column:
            above = (s["at"] + 1 >= window) & (total <= limit)
            begins = above & (s["first"].isNull() | (s["at"] + 1 - window > s["past"]))
            return F.struct(
                counts.alias("counts"), total.alias("sum"), (s["at"] + 1).alias("at"),
                F.when(begins, s["at"] + 1 - window).otherwise(s["first"]).alias("first"),
                F.when(above, s["at"] + 1).otherwise(s["past"]).alias("past"),
                F.when(begins & s["first"].isNotNull(), F.concat(s["closed"], own(s))).otherwise(s["closed"]).alias("closed"),
            )

        return let(total, moved)

    return F.aggregate(moves, zero, step, lambda s: F.when(s["first"].isNull(), s["closed"]).otherwise(F.concat(s["closed"], own(s))))


def _class_spans(c: Column, cls: CharacterClass) -> Column:
    return F.transform(_stretches(c["text"], cls), lambda s: _span(c["start"] + s["first"], c["start"] + s["past"], cls.kind))


def _entropy_spans(text: Column) -> Column:
    def pieces(c: Column) -> Column:
        left = F.filter(between(c["text"], F.lit(EXCUSED)), lambda p: F.char_length(p["text"]) >= min(cls.window for cls in CLASSES))
        left = F.transform(left, lambda p: F.struct((c["start"] + p["start"]).alias("start"), (c["start"] + p["past"]).alias("past"), p["text"].alias("text")))
        excused = c["text"].rlike(ALLOWED[0]) | c["text"].rlike(ALLOWED[1]) | c["text"].rlike(ALLOWED[2])
        return F.when(c["text"].rlike(ALLOWED[3]), F.array().cast(SPAN)).when(excused, left).otherwise(F.array(c))

    def one(c: Column) -> Column:
        out = F.array().cast(SPANS)
        for cls in reversed(CLASSES):
            out = F.when(c["text"].rlike(cls.regex), _class_spans(c, cls)).otherwise(out)
        return out

    candidates = F.flatten(F.transform(matches(text, F.lit(CANDIDATE)), pieces))
    found = F.flatten(F.transform(candidates, one))
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast(SPANS))


def _pattern_spans(text: Column, p: Pattern) -> Column:
    found = F.filter(matches(text, F.lit(p.regex)), lambda s: s["text"].rlike(p.valid))
    found = F.transform(found, lambda s: _span(s["start"], s["past"], p.kind))
    return F.when(text.rlike(p.regex), found).otherwise(F.array().cast(SPANS))


def secrets(docs: DataFrame, columns: list[str] | None = None, text: str = "text", names: tuple[str, str] = ("base", "spans")) -> DataFrame:
    """``columns`` of the documents (all by default) and two lists of spans.

    ``base`` holds the matches of the patterns, ``spans`` these and the entropy
    stretches that no such match contains, each as (start, rank, past, kind), places in code
    points, sorted by start and kind. A null or empty text has none. Rows come back as
    often as they came; columns that bear one of ``names`` are replaced.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in {n.lower() for n in names}]
    kept = docs.select(*dict.fromkeys([*columns, text]))
    body, more = fresh_names(kept, "body", "more")
    rows = kept.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    base = F.sort_array(F.concat(*(_pattern_spans(F.col(body), p) for p in PATTERNS)))
    rows = rows.select(*columns, base.alias(names[0]), _entropy_spans(F.col(body)).alias(more))
    return rows.select(*columns, names[0], _uncovered(F.col(names[0]), F.col(more)).alias(names[1]))


def _uncovered(base: Column, more: Column) -> Column:
    """The base spans and those further ones that none of them contains, sorted: one sweep by
    start, base spans first, against the farthest end of the base spans so far."""
    tagged = lambda spans, tag: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(tag).alias("tag"), s.alias("span")))

    def swept(every: Column) -> Column:
        ends = running(F.transform(every, lambda x: F.when(x["tag"] == 0, x["span"]["past"]).otherwise(0)), F.lit(0), F.greatest)
        marked = F.zip_with(every, ends, lambda x, end: F.struct((x["tag"] == 0).alias("own"), (end < x["span"]["past"]).alias("out"), x["span"].alias("span")))
        return F.transform(F.filter(marked, lambda x: x["own"] | x["out"]), lambda x: x["span"])

    kept = let(F.sort_array(F.concat(tagged(base, 0), tagged(more, 1))), swept)
    return F.when(F.size(more) > 0, F.sort_array(kept)).otherwise(base)


def number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:past, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["past"].cast("string"))), ",")


def masked(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """The documents with each stretch of secrets replaced by ``mask``; all else as it was, null texts too."""
    base, spans = fresh_names(docs, "base", "spans")
    rows = secrets(docs, text=text, names=(base, spans))
    body = F.col(text)

    def cut(code: Column) -> Column:
        """``code`` has four bytes a character, so a piece is found without going over the text."""
        ends = F.transform(F.col(spans), lambda x: x["past"])
        stretches = F.zip_with(F.col(spans), running(ends, F.lit(-1), F.greatest), lambda x, end: F.struct(x["start"].alias("first"), x["past"].alias("past"), end.alias("end")))

        def pieces(stretches: Column) -> Column:
            # A span that begins inside the one before it, or at its end, only moves the end.
            begins = F.filter(stretches, lambda x: x["first"] > x["end"])
            return let(begins, lambda begins: F.concat(F.transform(begins, lambda x: F.concat(_part(code, F.greatest(x["end"], F.lit(0)), x["first"]), F.lit(mask))), F.array(_part(code, F.array_max(ends), F.char_length(body)))))

        return F.array_join(let(stretches, pieces), "")

    new = F.when(F.size(spans) > 0, let(F.encode(body, "UTF-32"), cut)).otherwise(body)
    return rows.select(*(new.alias(c) if c == text else F.col(c) for c in docs.columns))


def _part(code: Column, start: Column, past: Column) -> Column:
    return F.decode(F.substring(code, start * 4 + 1, (past - start) * 4), "UTF-32")
