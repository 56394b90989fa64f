import hashlib
import random
import re

import pytest

from snapmart.llm import substrings


def brute(rows, length):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    rank = lambda i: float("inf") if i is None else i
    first = {}
    for i, w in texts:
        for p in range(len(w) - length + 1):
            key = tuple(w[p : p + length])
            first[key] = min(first.get(key, float("inf")), rank(i))
    out = []
    for i, w in texts:
        gone = set()
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < rank(i):
                gone.update(range(p, p + length))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "É", "x\x00y", "Long-Word", "d"]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(30):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        if i % 3 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage[rng.randint(0, 10) :]
        rows.append((rng.choice([None, i, i, i, 7]), rng.choice([" ", "\n", " \t"]).join(w), "en"))
    rows += [(100, None, "en"), (101, "", "en"), (102, "a " * 300, "fr"), (103, "a " * 200, "fr"), (99, "a " * 7, None), rows[0], (200, rows[0][1], "en"), (3, " ".join(passage * 20), "en")]
    return rows


@pytest.mark.parametrize(("seed", "length", "levels"), [(1, 8, 2), (2, 8, 3), (3, 8, 4), (4, 6, 2), (5, 2, 2)])
def test_matches_brute_force(spark, seed, length, levels):
    rows = made(seed)
    got = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, th string"), length, levels).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows, length)
    assert all(sum(s.past - s.first for s in r.spans) == r.n_removed for r in got)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = substrings.repeated_passages(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute([tuple(r) for r in docs.collect()], 50)


def test_empty_and_wrong_lengths(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.repeated_passages(docs).count() == 0
    with pytest.raises(ValueError):
        substrings.repeated_passages(docs, 50, 3)
