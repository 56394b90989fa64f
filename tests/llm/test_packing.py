import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from snapmart.llm import packing, tokenization

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "áb c", "ΑΣ ΑΣ.", "it's I'LL o'clock 'tis", "x\x1cy z \xa0q", "<|endoftext|> a b.", "A<|startoftext|>B", "\x00 b\x00c", "İstanbul K Å ﬁ", "é ́x", "日本 語 1234 ½", "a\u0085b", "", " ",
    "a.b,c!d '.' .'s x.'s", "http://x.org/a?b=c&d", "***word*** $$$ a#b", "naïve.\" «q» …", "😀👍🏽 źa", "ǅ ᾳ ß ﬀ", "ten 10.5% (a)", "𝒜lpha Ⅷ", "a" * 5000,
]


def test_ids_are_the_tokenizers():
    tokenizer, known = Tokenizer.from_file(PATH), tokenization.WordTokenizer(PATH)
    texts = [*ODD, *ODD, " ".join(ODD)]
    for _ in range(2):
        ids, cut = known.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[cut[i] : cut[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t
    tokenization.WORDS, before = 3, tokenization.WORDS
    ids, cut = known.encode(pa.array(texts))
    tokenization.WORDS = before
    assert ids.tolist() == [x for t in texts for x in tokenizer.encode(t, add_special_tokens=False).ids]


def plain_sum_of_squares(lengths, size):
    """Every choice weighed by the sum itself."""
    open_, out = [], []
    for n in lengths:
        def cost(gaps):
            return sum(gaps.count(g) ** 2 for g in set(gaps) if g)

        gaps = [g for g in open_]
        best = None
        for g in sorted({g for g in gaps if g >= n}):
            i = gaps.index(g)
            c = cost([*gaps[:i], g - n, *gaps[i + 1 :]])
            if best is None or c < best[0]:
                best = (c, g)
        fresh = cost([*gaps, size - n])
        if best is None or best[0] > fresh:
            open_.append(size - n)
            out.append(size)
        else:
            open_[gaps.index(best[1])] -= n
            out.append(best[1])
    return out


@pytest.mark.parametrize("seed", range(5))
def test_choices_are_the_smallest_sums(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 21, 120)
    sequence, offset = packing.sum_of_squares(lengths, 20)
    assert (20 - offset).tolist() == plain_sum_of_squares(lengths.tolist(), 20)
    check(zip(sequence, offset, lengths, strict=True), 20)


def check(rows, size):
    ends = {}
    for s, o, n in sorted(rows):
        assert ends.get(s, 0) == o
        ends[s] = o + n
        assert ends[s] <= size
    return len(ends)


@pytest.mark.parametrize("group", [50_000, 60])
def test_documents(spark, group):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(None, None), (7, ""), (7, ""), *((1000 + i, t) for i, t in enumerate(ODD))], docs.schema)
    rows = docs.unionByName(extra).collect()
    tokenizer, want = Tokenizer.from_file(PATH), []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(i, p, a, len(ids[a : a + 256]), zlib.crc32(np.array(ids[a : a + 256], "<u4").tobytes())) for p, a in enumerate(range(0, len(ids), 256))]
    got = packing.packed(docs.unionByName(extra).selectExpr("*", "1 AS piece"), PATH, 256, group).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    used = check([(r.sequence_id, r.offset, r.length) for r in got], 256)
    assert used <= 1.1 * sum(r.length for r in got) / 256 + len(want) / group


def test_empty(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
