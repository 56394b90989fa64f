import re

import numpy as np
import pytest
import xxhash

from snapmart.llm import simhash

SCHEMA = "doc_id long, text string, lang string"


def brute(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def brute_groups(rows):
    prints = [brute(t) for _, t, *_ in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {g: min((r[0] for r, x in zip(rows, label) if x == g and r[0] is not None), default=None) for g in label}
    return sorted(((r[0], p, least[g]) for r, p, g in zip(rows, prints, label)), key=str)


BASE = " ".join(f"word{i * 7 % 41}" for i in range(120))
ROWS = [
    (5, BASE, "en"), (3, BASE + " tail", "en"), (9, BASE.replace("word7 ", "other "), "en"), (1, None, None), (2, "", "en"),
    (4, " \t\n", "en"), (6, "one two", "en"), (7, "One TWO", "fr"), (8, "É é\x00 ß", "fr"), (None, BASE, None), (5, BASE, "en"),
    (10, "x " * 5000 + BASE * 20, "en"), (11, "entirely different words stand here", "en"),
]


def test_groups_match_brute_force(spark):
    got = simhash.near_groups(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == brute_groups(ROWS)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = simhash.near_groups(docs).collect()
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == brute_groups(rows)


@pytest.mark.parametrize("crowded", [0, 3, 1000])
@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_lose_none(spark, crowded, distance):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 12)
    prints = {int(c) for c in centre}
    for c in centre:
        for _ in range(25):
            flip = 0
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                flip |= 1 << int(b)
            prints.add(int(np.array([int(c) ^ flip], np.uint64).view(np.int64)[0]))
    prints = sorted(prints)
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), distance, crowded).collect()}
    want = {(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if bin((a ^ b) % 2**64).count("1") <= distance}
    assert got == want


def test_keep_one(spark):
    docs = spark.createDataFrame([(*r, "c") for r in ROWS], SCHEMA + ", component string")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    groups = {r[2] for r in brute_groups(ROWS)}
    assert sorted(r.doc_id for r in got.collect()) == sorted(groups)


def test_keep_one_repeated_and_null_ids(spark):
    rows = [(None, "a b c d", "x"), (None, "a b c d", "x"), (7, "some quite different words", "x"), (7, "nothing of the kind at all", "x"), (7, "nothing of the kind at all", "y")]
    got = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == [(7, "nothing of the kind at all"), (7, "some quite different words")]
    assert len(got) == 3


def test_keep_one_drops_copies_without_an_id(spark):
    near = BASE + " tail"
    assert brute_groups([(1, BASE), (2, near)])[1][2] == 1
    got = simhash.keep_one(spark.createDataFrame([(5, BASE, "x"), (None, near, "x"), (None, "entirely different words stand here", "x")], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "entirely different words stand here"), (5, BASE)]


def test_keep_one_drops_the_copy_that_shares_its_id(spark):
    rows = [(3, BASE, "x"), (7, BASE + " tail", "x"), (7, "entirely different words stand here", "x")]
    got = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(3, BASE), (7, "entirely different words stand here")]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_groups(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0
