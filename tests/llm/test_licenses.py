import re

from snapmart.llm import licenses
from snapmart.llm.license_rules import BASE, signatures

LOW = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_base(text):
    w, out = words(text), []
    for rank, (phrase, label) in enumerate(BASE):
        p = phrase.split()
        out += [(i, i + len(p), 0, rank, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return sorted(out)


def brute_found(text):
    """Every signature on the whole text, without the keyword gates, then suppression."""
    joined, hits = f" {' '.join(words(text))} ", []
    for rank, s in enumerate(signatures()):
        for m in re.finditer(rf"(?<= )(?:{s.pattern})(?= )", joined):
            start = joined[: m.start()].count(" ") - 1
            hits.append((start, start + m[0].count(" ") + 1, s.priority, rank, s.label))
    kept = [a for a in hits if not any(b[0] <= a[0] and a[1] <= b[1] and (b[2] > a[2] or (b[2] == a[2] and (b[1] - b[0], -b[3]) > (a[1] - a[0], -a[3]))) for b in hits)]
    return sorted(kept)


TEXTS = [
    None, "", "no licence here", "Licensed under CC BY-NC 4.0.", "cc, by! CC-BY-SA 3.0 accby", "GNU General Public License, version 3 or any later version", "All rights reserved. ALL RIGHTS RESERVED",
    "the MIT License and the Apache License, Version 2.0", "SPDX-License-Identifier: GPL-2.0-only", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "https://creativecommons.org/licenses/by-nc-sa/4.0/ x", "placed in the public domain", "public-domain work; as-is, basis", "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND", "É cc by é", "Alle Rechte vorbehalten. Tous droits réservés", "K ccKby", "cc\nby " * 30 + "general\tpublic  license",
    "word " * 5000 + "All rights reserved", "BSD 3-Clause License; BSD-3-Clause; zlib license; WTFPL", "Lesser General Public License v2.1", "copyright 2021 someone, proprietary and confidential",
]


def frame(spark):
    return spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, norm int")


def test_matches_brute_force(spark):
    got = licenses.licenses(frame(spark)).collect()
    assert len(got) == len(TEXTS) and got[0].norm == 7
    for r in got:
        text = TEXTS[r.doc_id]
        assert r.n_words == len(words(text))
        assert [tuple(x) for x in r.base] == brute_base(text), text
        assert [tuple(x) for x in r.found] == brute_found(text), text


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in licenses.licenses(docs, ["text"]).collect():
        assert r.n_words == len(words(r.text))
        assert [tuple(x) for x in r.base] == brute_base(r.text)
        if r.found or re.search("licen|reserv|copyright", r.text, re.IGNORECASE):
            assert [tuple(x) for x in r.found] == brute_found(r.text)


def test_gates():
    assert all(any(g in w for g in licenses.GATES for w in s.keyword.split()) for s in signatures())
    assert all(" " not in g for g in licenses.GATES)


def test_rules_are_many_and_empty_table(spark):
    assert len(signatures()) >= 200
    assert licenses.licenses(frame(spark).limit(0)).count() == 0


def alternatives(pattern):
    """Every text that a pattern matches, a digit standing for all."""
    from re import _parser

    def expand(part):
        out = [""]
        for op, arg in part:
            name = str(op)
            if name == "LITERAL":
                more = [chr(arg)]
            elif name == "IN":
                more = ["7"] if str(arg[0][0]) == "CATEGORY" else [chr(c) for _, c in arg]
            elif name == "SUBPATTERN":
                more = expand(arg[-1])
            elif name == "BRANCH":
                more = [x for b in arg[1] for x in expand(b)]
            else:
                assert name == "MAX_REPEAT" and arg[:2] == (0, 1), name
                more = ["", *expand(arg[2])]
            out = [a + b for a in out for b in more]
        return out

    return expand(_parser.parse(pattern))


def test_every_alternative_holds_its_keyword():
    lost = [(s.keyword, t) for s in signatures() for t in alternatives(s.pattern) if f" {s.keyword}" not in f" {t} "]
    assert lost == []


def test_alternatives_match_without_keywords(spark):
    texts = sorted({t for s in signatures() for t in alternatives(s.pattern)})
    for r in licenses.licenses(spark.createDataFrame([(t,) for t in texts], "text string")).collect():
        assert [tuple(x) for x in r.found] == brute_found(r.text), r.text


def test_very_many_matches_in_one_text(spark):
    import time

    began = time.time()
    rows = spark.createDataFrame([("mit license, apache license version 2.0; cc by " * 20_000,)], "text string")
    (r,) = licenses.licenses(rows).collect()
    assert len(r.base) == 20_000 and len(r.found) >= 40_000
    assert time.time() - began < 60
