import re

import pytest

from snapmart.llm import decontam

LOW = {c: c + 32 for c in range(65, 91)}


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(text, items, size=10):
    words, hit, ids = split(text), set(), set()
    for item_id, item in items:
        w = split(item)
        n = min(size, len(w))
        for win in {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else ():
            for p in range(len(words) - n + 1):
                if tuple(words[p : p + n]) == win:
                    hit.update(range(p, p + n))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(words), len(hit), sorted(ids)


LONG = " ".join(f"w{i % 13}" for i in range(60))
ITEMS = [
    (1, "Alpha beta, gamma delta. Epsilon zeta eta theta iota kappa lambda mu"), (2, "short one"), (3, None), (4, " .,- "), (10, "Short ONE!"),
    (None, "no id here"), (5, "É é ß ñ ö ü à ç ê î ô û"), (6, LONG), (7, "x"), (1, "second text of item one that is long enough to be two windows"),
]
DOCS = [
    (1, "so alpha BETA gamma delta epsilon zeta eta theta iota kappa then", "a"), (2, None, "b"), (3, "", "c"), (4, "short  one, short-one", "d"),
    (5, "alpha beta gamma delta epsilon", "e"), (6, "no id here x", "f"), (7, "é É ß ñ ö ü à ç ê î ô", "g"), (8, LONG + " " + LONG, "h"), (8, LONG + " " + LONG, "h"),
    (None, "xx x " * 3000, "i"), (9, "item one that is long enough to be two windows", "j"), (11, "nothing", "k"),
]


def rows(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, items string"), spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("options", [{}, {"filter_bits": 64}, {"filter_bits": 1 << 16}, {"shingle": 1}, {"shingle": 12}, {"window": 4}])
def test_matches_brute_force(spark, options):
    docs, items = rows(spark)
    got = decontam.contamination(docs, items, ["doc_id"], **options).collect()
    want = [(d[0], *brute(d[1], ITEMS, options.get("window", 10))) for d in DOCS]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == sorted(want, key=str)
    assert all(sum(s.past - s.first for s in r.spans) == r.n_hit for r in got)


def test_clean_documents(spark):
    docs, items = rows(spark)
    got = decontam.clean_documents(docs, items)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted((d for d in DOCS if not brute(d[1], ITEMS)[1]), key=lambda d: d[0])


def test_empty(spark):
    docs, items = rows(spark)
    assert decontam.contamination(docs.limit(0), items).count() == 0
    none = decontam.contamination(docs, items.limit(0), ["doc_id"]).collect()
    assert len(none) == len(DOCS) and all(r.n_hit == 0 and r["items"] == [] for r in none)


def test_a_place_shared_by_many_windows_and_copies(spark):
    head = "please answer the following question in one"
    items = [(i, f"{head} word number n{i} now") for i in range(300)]
    docs = [(i, f"so {head} word number n{i % 400} now and here", "") for i in range(900)] + [(5000 + i, f"x {head} word number n7 now", "") for i in range(500)]
    got = decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string, extra string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    texts = {d[0]: d[1] for d in docs}
    want = {t: brute(t, items)[1:] for t in set(texts.values())}
    for r in got.collect():
        assert (r.n_hit, r["items"]) == want[texts[r.doc_id]]


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, ITEMS[0][1], 3, "p", "q"), (1, ITEMS[0][1], 3, "p", "q"), (2, None, 4, "p", "q")], "doc_id long, text string, a long, places string, win string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.contamination(docs, items).collect()
    assert [(r.doc_id, r.a, r.places, r.win, r.n_hit) for r in sorted(got, key=lambda r: r.doc_id)] == [(1, 3, "p", "q", 12)] * 2 + [(2, 4, "p", "q", 0)]
    assert [tuple(r) for r in decontam.clean_documents(docs, items).collect()] == [(2, None, 4, "p", "q")]
    with pytest.raises(ValueError):
        decontam.contamination(docs, items, filter_bits=100)


def test_clean_documents_are_not_shuffled(spark):
    docs, items = rows(spark)
    plan = decontam.clean_documents(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 1 and "Exchange" not in plan.split("Union")[1].split("Join")[0]
    counted = decontam.contamination(docs, items, ["doc_id"])
    joined = [line for line in counted._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joined) == 1
    for options in ({"filter_bits": 1}, {"filter_bits": 64}, {}):
        assert sorted(map(str, decontam.clean_documents(docs, items, **options).collect())) == sorted(str(r) for r in docs.collect() if not brute(r.text, ITEMS)[1])
