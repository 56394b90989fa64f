import re
import unicodedata
from collections import Counter

from snapmart.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    letters = sum(unicodedata.category(c).startswith("L") for c in text)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_letters": letters,
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_bullets": sum(bool(re.match(r"[ \t]*[-*•]", x)) for x in lines), "n_ellipses": sum(bool(re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*$", x)) for x in lines),
    }


TEXTS = [
    None, "", " \n\t", "a b c d e", "a b c d e f a b c d e", "one\none\n \none ", "é😀 # * $ % & | < > x\x00y", "- a\n* b\n• c…\nd...\n", "x " * 3000, "a b c d e a b c d e a b c d e " * 40,
    "aaaaaa" * 5, "\r\nline\r\nline\r\n", "日本語 テキスト です ね え", "a a a a a a a a a a a a", "  nbsp em", "word " + "q" * 50_000,
]


def frame(spark):
    return spark.createDataFrame([(i, t, -1, "w") for i, t in enumerate(TEXTS)] * 2, "doc_id long, text string, n_words int, words string")


def test_measures_match_brute_force(spark):
    got = quality.ledger(frame(spark)).collect()
    assert len(got) == 2 * len(TEXTS) and got[0].n_words == -1 and got[0].words == "w"
    for r in got:
        assert r.m.asDict() == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_bits_and_policies(spark):
    rows = quality.ledger(frame(spark), ["doc_id"])
    for r in rows.collect():
        want = sum(quality.BIT[x.name] for x in quality.RULES if eval(x.fails, {}, brute(TEXTS[r.doc_id])))  # the rules are plain comparisons
        assert r.failed == want
    policy = quality.POLICIES[quality.CURRENT]
    failed = [r.failed for r in rows.collect()]
    for r in quality.ablation(rows, policy).collect():
        bit = quality.BIT[r.rule]
        assert r.failing == sum(f & bit != 0 for f in failed)
        assert r.rejected_without == sum(f & policy.mask & ~bit != 0 for f in failed)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in quality.ledger(docs, ["text"]).collect():
        assert r.m.asDict() == brute(r.text)


def test_empty(spark):
    assert quality.ledger(frame(spark).limit(0)).count() == 0
