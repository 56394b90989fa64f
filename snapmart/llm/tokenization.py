"""Token ids of whole texts with a word-splitting tokenizer, each distinct word encoded once.

The tokenizer of ``word_bpe_49k.json`` composes and lower-cases characters, drops white
space and splits between letters or digits and other signs, and encodes what is left
piece by piece. So the ids of a text are those of its parts, one after the other, if it
is cut at ASCII white space and between an ASCII letter or digit and an ASCII sign other
than the apostrophe (which may begin a contraction). Parts are told apart by a 64-bit
hash; a worker keeps the ids of up to ``WORDS`` of them.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from snapmart.llm.textkernel import SPACED_LOWER, Words, expand, text_bytes, words

WORDS = 500_000
#: 1 for ASCII letters and digits, 2 for the other printable ASCII characters but the apostrophe.
KINDS = np.zeros(256, np.uint8)
KINDS[0x21:0x7F] = 2
KINDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KINDS[0x27] = 0


def parts(column: pa.Array) -> Words:
    return words(column, SPACED_LOWER, KINDS)


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ending = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ending[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.forget()

    def forget(self) -> None:
        self.place: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1, np.int64)

    def _learn(self, hashes: list[int], texts: list[str]) -> None:
        # Words of letters alone end in one end-of-word id each, so many of them are encoded as one text.
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        ids = self._fast([" ".join(texts[i] for i in plain)])[0]
        ends = np.flatnonzero(self.ending[ids]) + 1
        if len(ends) != len(plain):  # letters that the tokenizer does not take for such
            plain, ids, ends = [], ids[:0], ends[:0]
        known = set(plain)
        odd = [i for i in range(len(texts)) if i not in known]
        found = self._fast([texts[i] for i in odd])
        new = np.concatenate([ids, *found])
        count = np.concatenate([np.diff(ends, prepend=0), np.array([len(f) for f in found], np.int64)])
        at = int(self.first[-1])
        if at + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(new), len(self.ids)), np.uint32)])
        self.ids[at : at + len(new)] = new
        self.place.update(zip((hashes[i] for i in [*plain, *odd]), range(len(self.place), len(self.place) + len(hashes)), strict=True))
        self.first = np.concatenate([self.first, at + np.cumsum(count)])

    def _fast(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column without nulls, one after the other, and where each text's begin (and the last ends)."""
        w = parts(column)
        distinct, sample, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if len(self.place) + len(distinct) > WORDS:
            self.forget()
        names = distinct.tolist()
        new = [i for i, h in enumerate(names) if h not in self.place]
        if new:
            data = text_bytes(column)[0].tobytes()
            spots = sample[new]
            texts = [data[a:b].decode() for a, b in zip(w.start[spots].tolist(), w.end[spots].tolist(), strict=True)]
            self._learn([names[i] for i in new], texts)
        row = np.fromiter((self.place[h] for h in names), np.int64, len(names))
        count = (self.first[row + 1] - self.first[row])[inverse]
        ids = self.ids[expand(self.first[row][inverse], count)] if len(count) else np.zeros(0, np.uint32)
        cut = np.concatenate([[0], np.cumsum(count)])[w.first]
        data = text_bytes(column)[0].tobytes()
        if not any(t in data for t in self.special):
            return ids, cut
        # A text that spells a special token is left to the tokenizer whole.
        each = [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        for i, text in enumerate(column.to_pylist()):
            if any(t.decode() in text for t in self.special):
                each[i] = self._fast([text])[0]
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(e) for e in each])])


_known: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a file, with the words it has met."""
    if path not in _known:
        _known[path] = WordTokenizer(path)
    return _known[path]
