"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for a document. The ledger keeps its measurements and
one bit a failed rule; a policy is a version and a mask of rules that reject.
Policies, their differences and ablations are then bit operations on the ledger,
without another look at a text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import fresh_names, let

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
GRAM = 5


@dataclass(frozen=True)
class Rule:
    """A rule fails where the condition over the measurements holds."""

    name: str
    fails: str


#: The place of a rule is its bit: append new ones, never reorder.
RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("mean_word_short", "word_chars < 2 * n_words"),
    Rule("mean_word_long", "word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("few_letters", "2 * n_letters < word_chars"),
    Rule("bullets", "10 * n_bullets > 9 * n_lines"),
    Rule("ellipses", "10 * n_ellipses > 3 * n_lines"),
    Rule("too_many_words", "n_words > 1000000"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


POLICIES = {
    1: Policy(1, ("too_few_words", "repeated_windows")),
    2: Policy(2, ("too_few_words", "repeated_windows", "mean_word_short", "mean_word_long", "symbols", "duplicate_lines", "few_letters", "bullets", "ellipses")),
}
CURRENT = 2


def _repeat_words(words: Column) -> Column:
    """Words inside a window of five words that stands twice or more in the array."""
    starts = F.size(words) - (GRAM - 1)
    grams = F.transform(F.sequence(F.lit(0), starts - 1), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(GRAM))))

    def repeated(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_covered(hashes))

    return F.when(starts >= 2, let(grams, repeated)).otherwise(F.lit(0))


def _covered(hashes: Column) -> Column:
    """The windows are sorted by hash; those beside an equal one are repeated. In
    order of place, each covers the words that the next one does not begin."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twins = let(placed, lambda a: F.zip_with(a, F.slice(a, 2, F.size(a)), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>"))))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda t: t.isNotNull()))))
    gains = let(places, lambda a: F.zip_with(a, F.slice(a, 2, F.size(a)), lambda x, y: F.least(F.lit(GRAM), F.coalesce(y - x, F.lit(GRAM)))))
    return F.aggregate(gains, F.lit(0), lambda total, g: total + g)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with an added struct ``m`` of measurements."""
    body, words, lines = fresh_names(docs, "body", "words", "lines")
    rows = docs.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumns({
        words: F.regexp_extract_all(F.col(body), F.lit(WORD), F.lit(0)),
        lines: F.filter(F.split(F.col(body), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })

    def left(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(F.col(body), pattern, ""))

    def having(pattern: str) -> Column:
        return F.size(F.filter(F.col(lines), lambda x: x.rlike(pattern)))

    m = {
        "n_words": F.size(words), "word_chars": left(SPACE), "n_symbols": F.char_length(body) - left(SYMBOL), "n_letters": left(r"\P{L}+"),
        "n_lines": F.size(lines), "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_repeat_words": _repeat_words(F.col(words)),
        "n_bullets": having(r"^[\x20\x09]*[-*\u2022]"), "n_ellipses": having(r"(\.\.\.|\u2026)[\x20\x09-\x0D]*$"),
    }
    return rows.select(*docs.columns, F.struct(*(c.cast("long").alias(n) for n, c in m.items())).alias("m"))


def ledger(docs: DataFrame, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """``columns`` of the documents (all by default), struct ``m`` and long ``failed``.

    ``m`` holds the measurements, ``failed`` the bits of the rules that fail. A null
    text counts as the empty one: no words, no lines, too few words. A text of one
    line has no repeated line; windows are those that lie in the text whole. Rows
    come back as often as they came; columns of the documents called ``m`` or
    ``failed`` are replaced.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in ("m", "failed")]
    rows = measured(docs.select(*dict.fromkeys([*columns, text])), text)
    bits = F.lit(0).cast("long")
    for rule in RULES:
        # The measurements are named in full: a document column may bear the same name.
        fails = F.expr(re.sub(r"\b(n_\w+|word_chars)\b", r"m.\1", rule.fails))
        bits = bits.bitwiseOR(F.when(fails, F.lit(BIT[rule.name])).otherwise(F.lit(0)).cast("long"))
    return rows.select(*columns, "m", bits.alias("failed"))


def rejected(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """(version, rule, failing, rejected_without): for each rule of the policy, the documents that
    fail it, and those still rejected if it were taken out. One pass; the bits are counted before
    the shuffle, and there are no more groups than combinations of bits."""
    counts = rows.groupBy("failed").agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(policy.version).alias("version"), F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules))
    failed, bit = F.col("failed"), F.col("bit")
    without = failed.bitwiseAND(F.lit(policy.mask).cast("long")).bitwiseAND(F.bitwise_not(bit))
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return counts.select("failed", "n", F.inline(rules)).groupBy("version", "rule").agg(
        count(failed.bitwiseAND(bit) != 0).alias("failing"), count(without != 0).alias("rejected_without")
    )
