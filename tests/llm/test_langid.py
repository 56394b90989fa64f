import zlib

import numpy as np

from snapmart.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    rows = docs.collect()
    names, scores = model.predict([r.text or "" for r in rows])
    held = [(r.lang, n) for r, n in zip(rows, names, strict=True) if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 200 and np.mean([a == b for a, b in held]) > 0.98
    assert scores.min() >= 0 and scores.max() <= 1 and set(names) <= {r.lang for r in rows}
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identified(docs.drop("lang", "source"), model, ["doc_id"]).collect()}
    assert got.keys() == {r.doc_id for r in rows}
    assert all(got[r.doc_id][0] == n and abs(got[r.doc_id][1] - s) < 1e-4 for r, n, s in zip(rows, names, scores, strict=True))
    flag = docs.select("doc_id", langid.held_out(docs.doc_id).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in flag)


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    wrong = docs.selectExpr("doc_id", "text", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2, 'xx', lang) AS lang")
    a, b = langid.train(docs), langid.train(wrong)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def test_odd_rows(spark):
    model = langid.fit(["the and of with that this", "der die das und mit von"] * 5, ["en", "de"] * 5)
    rows = [(1, None, "k"), (2, "", "k"), (3, "123 !? ###", "k"), (None, "the and of the", "k"), (5, "und der " * 40_000, None), (5, "und der " * 40_000, None), (6, "日本語", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = langid.identified(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    found = [(r.doc_id, r.lang_pred) for r in got.collect()]
    assert found[:6] == [(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "de"), (5, "de")] and found[6][1] in ("en", "de")
    assert langid.with_language(docs, model).columns == docs.columns and langid.with_language(docs, model).count() == 4
    assert langid.identified(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.predict(["some words"]) [0] == ["und"]


def test_documents_stay_without_a_model(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !", None), (3, None, None), (None, "\u00e9", None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in langid.with_language(docs, langid.train(docs)).collect()] == [1, None]


def test_long_texts_are_learned_from(spark):
    long = {"en": "the and of with that this ", "de": "der die das und mit von "}
    rows = [(i, "12 " * langid.LONGEST + long[n] * 2000, n) for i in range(1, 13) for n in long]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.languages == ["de", "en"]
    assert model.predict(["the and of with", "und mit von der"])[0] == ["en", "de"]
    assert langid.with_language(docs, model).count() == len(rows)


def test_kernel_is_the_share_of_common_ngrams():
    def grams(t):
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    a, b = "abcabd", "bcabdx"
    got = langid.presence([a, b])
    want = len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b)))
    assert abs(float(got[0] @ got[1]) - want) < 1e-6  # no two of these share a bucket


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: letters[n % 26] + letters[n // 26 % 26] + letters[n * 7 % 26]
    rows = [(i, f"{word(n)} {word(n)}{word(n)} " * 20, f"l{n:03d}") for n in range(250) for i in range(n * 8, n * 8 + 8)]
    rows += [(3, f"abc {i}", "l000") for i in range(4000)]  # one much repeated id
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(langid.train(docs).languages) >= 245  # but for those of which every id is held out


def test_missing_languages_are_filled_in(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL")
    model = langid.train(docs)
    unmarked = docs.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, NULL, lang) AS lang", "lang AS true_lang")
    rows = langid.with_language(unmarked, model).collect()
    assert all(r.lang == r.true_lang for r in rows if r.doc_id % 2)
    assert np.mean([r.lang == r.true_lang for r in rows if r.doc_id % 2 == 0]) > 0.98
