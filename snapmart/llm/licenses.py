"""Licence signatures in texts: keyword gates, ordered patterns, suppression of contained matches.

Most texts hold no keyword and are left after plain substring tests. The others are
reduced to their words, and every signature whose keyword is there is matched.
Matches are intervals of words; one that lies inside a match of a higher priority,
or of the same priority and longer, or equal and earlier in the list, is suppressed.
Built-in functions only; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import fresh_names, let
from snapmart.llm.license_rules import BASE, signatures
from snapmart.llm.spans import running

#: A word, any case; lower-casing A-Z changes neither number nor places of words. The
#: bytes between words are listed one by one: the JVM tests such a class with one
#: table look-up, a class of ranges with a chain of calls (ten times the time).
WORD = "[^" + "".join(f"\\x{b:02X}" for b in range(128) if not chr(b).isalnum()) + "]+"
HIT = "array<struct<start:int,past:int,priority:int,rank:int,label:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = signatures()


#: Words that many texts hold; a gate only for keywords that have no other word of some length.
COMMON = {"what", "want", "public", "source", "basis", "promote", "terms", "use", "copy", "material", "work", "blue", "file"}


def _choices(keyword: str) -> set[str]:
    words = set(keyword.split())
    rare = words - COMMON
    least = min(4, max(map(len, words)))
    return {w for w in rare if len(w) >= least} or {w for w in words if len(w) >= least}


def _gates() -> list[str]:
    """Words one of which stands in every keyword, few of them: each next one is in the most keywords left."""
    left, out = {r.keyword for r in RULES} | {p for p, _ in BASE}, []
    while left:
        words = set().union(*map(_choices, left))
        best = max(words, key=lambda w: (sum(w in k for k in left), len(w), w))
        out.append(best)
        left = {k for k in left if best not in k}
    return out


#: A text without any of these, as a part of it, holds no keyword, whatever stands between its words.
GATES = _gates()
LEVELS = sorted({r.priority for r in RULES})


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _spaces(c: Column) -> Column:
    return F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))


def _hits(words: Column, pattern: Column, priority: Column, rank: Column, label: Column) -> Column:
    """Matches of a pattern in `` word word ... `` as word intervals."""
    pieces, found = F.split(words, pattern, -1), F.regexp_extract_all(words, pattern, F.lit(0))
    steps = F.zip_with(pieces, found, lambda a, b: F.struct(_spaces(a).alias("gap"), _spaces(b).alias("n")))
    steps = F.filter(steps, lambda s: s["n"].isNotNull())

    def placed(steps: Column) -> Column:
        at = running(F.transform(steps, lambda x: x["gap"] + x["n"]), F.lit(0), lambda a, x: a + x)

        def one(x: Column, a: Column) -> Column:
            first = a + x["gap"] - 1  # one space stands before the first word
            return F.struct(first.alias("start"), (first + x["n"] + 1).alias("past"), priority.alias("priority"), rank.alias("rank"), label.alias("label"))

        return F.zip_with(steps, at, one)

    return F.when(F.size(found) > 0, let(steps, placed)).otherwise(F.array().cast(HIT))


def _whole(pattern: str) -> str:
    return rf"(?<= )(?:{pattern})(?= )"


def _kept(hits: Column) -> Column:
    """The hits that lie in no other one that outranks them: one of a higher priority, or of the same and
    longer, or as long and earlier in the rules.

    One sweep: in the order of start, length, priority and rule, whatever outranks a hit and contains it
    stands before it, so the farthest end of those before it, at its priority or above, decides.
    """
    order = F.transform(hits, lambda h: F.struct(h["start"].alias("start"), (-h["past"]).alias("shorter"), (-h["priority"]).alias("lower"), h["rank"].alias("rank"), h.alias("hit")))

    def swept(order: Column) -> Column:
        ends = F.array(*(
            running(F.transform(order, lambda x: F.when(x["hit"]["priority"] >= level, x["hit"]["past"]).otherwise(-1)), F.lit(-1), F.greatest)
            for level in LEVELS
        ))

        def kept(ends: Column) -> Column:
            def out(x: Column, i: Column) -> Column:
                own = F.get(ends, F.array_position(F.array(*map(F.lit, LEVELS)), x["hit"]["priority"]).cast("int") - 1)
                return F.get(own, i) < x["hit"]["past"]

            return F.transform(F.filter(order, out), lambda x: x["hit"])

        return let(ends, kept)

    return let(F.sort_array(order), swept)


def licenses(docs: DataFrame, columns: list[str] | None = None, text: str = "text", names: tuple[str, str, str] = ("n_words", "base", "found")) -> DataFrame:
    """``columns`` of the documents (all by default), and:

    n_words; base, the places of the counted phrases, and found, the signatures that
    stay, both lists of (start, past, priority, rank, label) in words, in order of
    start. A null or empty text has no words and no places. Rows come back as often
    as they came; columns that bear one of ``names`` are replaced. The work is linear in
    the length of a text and, but for sorting, in its matches.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in {n.lower() for n in names}]
    kept = docs.select(*dict.fromkeys([*columns, text]))
    body, norm = fresh_names(kept, "body", "norm")
    rows = kept.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    gate = _any(F.lower(F.col(body)))
    words = F.regexp_extract_all(_ascii_lower(F.col(body)), F.lit(WORD), F.lit(0))
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    rows = rows.withColumns({norm: F.when(gate, joined)})

    base = F.flatten(F.array(*(_hits(F.col(norm), F.lit(_whole(p)), F.lit(0), F.lit(i), F.lit(label)) for i, (p, label) in enumerate(BASE))))
    table = F.array(*(F.struct(F.lit(f" {r.keyword}").alias("keyword"), F.lit(_whole(r.pattern)).alias("pattern"), F.lit(r.priority).alias("priority"), F.lit(i).alias("rank"), F.lit(r.label).alias("label")) for i, r in enumerate(RULES)))
    matched = F.flatten(F.transform(F.filter(table, lambda r: F.contains(F.col(norm), r["keyword"])), lambda r: _hits(F.col(norm), r["pattern"], r["priority"], r["rank"], r["label"])))
    none = F.array().cast(HIT)
    return rows.select(
        *columns,
        F.size(F.regexp_extract_all(F.col(body), F.lit(WORD), F.lit(0))).cast("long").alias(names[0]),
        F.when(F.col(norm).isNotNull(), F.sort_array(base)).otherwise(none).alias(names[1]),
        F.when(F.col(norm).isNotNull(), F.sort_array(let(matched, _kept))).otherwise(none).alias(names[2]),
    )


def _any(low: Column) -> Column:
    out = F.lit(False)
    for g in GATES:
        out = out | F.contains(low, F.lit(g))
    return out


def labels(hits: Column) -> Column:
    """The distinct labels of hits, sorted."""
    return F.sort_array(F.array_distinct(F.transform(hits, lambda h: h["label"])))


def score(found: Column, base: Column) -> Column:
    """0 without any hit, else the strongest priority as a part of the highest; a counted phrase alone is a plain name."""
    best = F.array_max(F.concat(F.transform(found, lambda h: h["priority"]), F.transform(base, lambda _: F.lit(3))))
    return F.coalesce(best / F.lit(5.0), F.lit(0.0))
