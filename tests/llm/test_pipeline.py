import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from snapmart.llm import langid
from test_decontam import brute as leaked
from test_secrets import masked
from test_simhash import brute_groups

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = langid.train(docs)
    rows = [r for r, name in zip(rows, model.predict([t or "" for _, t in rows])[0], strict=True) if name != "und"]
    rows = [r for r, (_, _, component) in zip(sorted(rows, key=lambda r: str(r)), brute_by_id(rows), strict=True) if r[0] == component]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(i, masked(t)) for i, t in rows if not leaked(t, items)[1]]
    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), set()
    for i, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.add((i, p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def brute_by_id(rows):
    found = {i: x for i, *x in brute_groups(rows)}
    return [(i, *found[i]) for i, _ in sorted(rows, key=lambda r: str(r))]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(0).unionByName(spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "x", 0), (1, "", "en", "x", 0)], docs.schema))
    for frame in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SF)
            assert frame.columns == docs.columns and [t for _, t in frame.dtypes] == [t for _, t in docs.dtypes]
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() == 0
