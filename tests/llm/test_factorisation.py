import zlib

import numpy as np
import pyarrow as pa
import pytest

from snapmart.llm import factorisation as fm
from snapmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, n_chars long, score string"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


FREE, FREE_TOO = [i for i in range(2, 20) if not held(i)][:2]


def test_margin_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    model = fm.Model(0.3, rng.normal(size=fm.WIDTH), rng.normal(size=(fm.WIDTH, fm.FACTORS)))
    texts = ["", "one", "one two  two\nthree!", "ALL CAPS 12 ### caps", "x " * 30]
    x = fm.features(pa.array(texts), [np.array([0, 1, 2, 3, fm.BINS - 1])])
    got = model.margin(x)[0]
    for r in range(len(texts)):
        index, value = x.index[x.first[r] : x.first[r + 1]], x.value[x.first[r] : x.first[r + 1]]
        assert len(set(index)) == len(index)
        want = model.bias + sum(model.weights[i] * v for i, v in zip(index, value))
        for a in range(len(index)):
            for b in range(a):
                want += model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b]
        assert abs(got[r] - want) < 1e-9


def test_features_do_not_depend_on_the_batch():
    texts = ["", "a b c\na b c", "é ü ü", "word " * 500, "A\n\nB."]
    whole = fm.features(pa.array(texts), [])
    for r, t in enumerate(texts):
        one = fm.features(pa.array([t]), [])
        span = slice(whole.first[r], whole.first[r + 1])
        assert np.array_equal(one.index, whole.index[span]) and np.allclose(one.value, whole.value[span])


def test_gradient_steps_lower_the_loss():
    words = [("good fine", 1), ("bad worse", 0), ("good worse", 0), ("bad fine", 0)] * 40
    x = [fm.features(pa.array([t]), []) for t, _ in words]
    model = fm.fit([(f.index, f.value) for f in x], [y for _, y in words])
    got = [float(model.score(f)[0]) >= 0.5 for f in x]
    assert got == [bool(y) for _, y in words]  # only the pair of words tells


def test_held_out_accuracy_of_the_query(spark):
    rows = QUERIES["op11_quality_classifier"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert len(right) > 80 and np.mean(right) > 0.97


def test_held_out_labels_are_not_used(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    wrong = labels.selectExpr("doc_id", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1, 1 - quality, quality) AS quality")
    a, b = fm.train(docs, labels), fm.train(docs.drop("lang", "source"), wrong)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.factors, b.factors)


def test_odd_rows(spark):
    ids = [i for i in range(200) if not held(i)]
    rows = [(i, "fine words here" if i % 2 else "### $$$ %%%", 5, "k") for i in ids]
    rows += [(None, None, None, "k"), (7, None, -1, "k"), (7, "", 0, None), (8, "w " * 300_000, 1, "k"), (8, "w " * 300_000, 1, "k")]
    docs = spark.createDataFrame(rows, DOCS)
    marks = [(i, i % 2) for i in ids] * 2 + [(None, 1), (4, None), (5, 7), (6, 0), (6, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = fm.train(docs, labels, metadata=["n_chars", "score"])
    got = fm.scored(docs, model, metadata=["n_chars", "score"])
    assert got.columns == ["doc_id", "text", "n_chars", "score"] and dict(got.dtypes)["score"] == "double"
    found = got.collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in found if r.doc_id and r.n_chars == 5)
    assert len({r.score for r in found if r.doc_id == 8 and r.n_chars == 1}) == 1
    assert fm.scored(docs.limit(0), model, metadata=["n_chars", "score"]).count() == 0


@pytest.mark.parametrize("marks", [[], [(FREE, 1)], [(FREE, 0)], [(None, 1)]])
def test_few_or_no_labels(spark, marks):
    docs = spark.createDataFrame([(FREE, "some words", 3, None), (FREE + 50, None, None, None)], DOCS)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in fm.scored(docs, fm.train(docs, labels)).collect()}
    if marks in ([], [(None, 1)]):
        assert set(scores.values()) == {0.5}
    else:
        assert scores[FREE] != 0.5 and (scores[FREE] > 0.5) == bool(marks[0][1])


def test_one_id_may_hold_most_rows(spark):
    rows = [(FREE, f"text {i}", i, None) for i in range(3000)] + [(FREE_TOO, "other", 1, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(FREE, 1), (FREE_TOO, 0)], "doc_id long, quality int")
    model = fm.train(docs, labels)
    assert model.weights.any()
    assert fm.scored(docs, model).count() == len(rows)
