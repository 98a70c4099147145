"""Ids of whole texts by a ``tokenizers`` file, each distinct word encoded once per worker.

For a pipeline that drops white space, lower-cases and splits at a pattern,
the ids of a text are those of its white-space separated words one after the
other, and closing marks can be cut off a word. That is used for texts of plain characters only (ASCII and Latin
letters whose normal form and lower case are the same everywhere); any
other text goes to the library as a whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from tokenizers import Tokenizer

from wikipassages.llm.common import cached
from wikipassages.llm.rlz import spread
from wikipassages.llm.words import Words, text_bytes, words_from

#: Distinct words that a worker remembers; beyond that its memory starts anew.
MEMORY = 1_500_000

# Plain bytes: white space, printable ASCII, and two-byte characters U+00A1 .. U+017E but U+0130.
_PLAIN = np.zeros(256, bool)
_PLAIN[[9, 10, 11, 12, 13, *range(32, 127), *range(0x80, 0xC0), *range(0xC2, 0xC6)]] = True
#: Marks that end a word and are a piece of their own after a letter or digit.
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".,!?;:")] = True
_WORD_END = np.zeros(256, bool)
_WORD_END[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def plain_texts(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which texts consist of plain characters."""
    bad = ~_PLAIN[data]
    lead = np.flatnonzero((data >= 0xC2) & (data < 0xC6))
    first, second = data[lead], data[np.minimum(lead + 1, max(0, len(data) - 1))]
    bad[lead[((first == 0xC2) & (second < 0xA1)) | ((first == 0xC4) & (second == 0xB0)) | ((first == 0xC5) & (second > 0xBE))]] = True
    sums = np.append(0, np.cumsum(bad))
    return sums[docs[1:]] == sums[docs[:-1]]


def split_words(data: np.ndarray, docs: np.ndarray) -> Words:
    """Words of plain texts, closing marks after a letter or digit as words of their own."""
    w = words_from(data, docs)
    core = w.end.copy()
    live = np.flatnonzero(_CLOSING[data[core - 1]]) if len(core) else np.zeros(0, np.int64)
    marked = live
    while len(live):
        core[live] -= 1
        live = live[core[live] > w.start[live]]
        live = live[_CLOSING[data[core[live] - 1]]]
    marked = marked[core[marked] > w.start[marked]]
    last, before = data[core[marked] - 1], data[np.maximum(core[marked] - 2, 0)]
    latin = (last >= 0x80) & (((before == 0xC3) & (last != 0x97) & (last != 0xB7)) | (before == 0xC4) | (before == 0xC5))
    marked = marked[_WORD_END[last] | latin]
    ends = w.end.copy()
    ends[marked] = core[marked]
    return Words(data, docs, np.insert(w.start, marked + 1, core[marked]), np.insert(ends, marked + 1, w.end[marked]),
                 w.first + np.searchsorted(marked, w.first))



class WordIds:
    """The words known so far: sorted 64-bit hashes, and where their ids stand in one pool."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.memory = memory
        self._forget()
        self.per_word = self._drops_white_space()

    def _forget(self) -> None:
        self.hash, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _drops_white_space(self) -> bool:
        """Whether words on their own give the text's ids, tried on a text with all kinds of plain characters."""
        probe = "It's a Tést, don't: 3.14 'RE \t\n x'll--y_z. «Ünï», 2².! O'Neill's? a'.. B:;"
        w = split_words(*text_bytes(pa.array([probe])))
        raw = w.data.tobytes()
        return self.library_ids(probe) == [i for a, b in zip(w.start, w.end) for i in self.library_ids(raw[a:b].decode())]

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hash, hashes)
        inside = np.minimum(at, max(0, len(self.hash) - 1))
        return inside, (self.hash[inside] == hashes) if len(self.hash) else np.zeros(len(hashes), bool)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Encodes new words (ascending distinct hashes) in one call."""
        found = self.library.encode(words, is_pretokenized=True, add_special_tokens=False)
        at = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(words) + 1))
        where = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, where, hashes)
        self.start = np.insert(self.start, where, len(self.pool) + at[:-1])
        self.length = np.insert(self.length, where, np.diff(at))
        self.pool = np.concatenate([self.pool, np.array(found.ids, np.uint32)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column, and n + 1 offsets; null counts as empty."""
        data, docs = text_bytes(column)
        plain = plain_texts(data, docs) if self.per_word else np.zeros(len(column), bool)
        own = {}
        if not plain.all():
            own = {i: np.array(self.library_ids(column[i].as_py() or ""), np.uint32) for i in np.flatnonzero(~plain).tolist()}
            kept = np.repeat(plain, np.diff(docs))
            data, docs = data[kept], np.append(0, np.cumsum(np.where(plain, np.diff(docs), 0)))
        w = split_words(data, docs)
        codes, hashes = pd.factorize(w.hashes(lower=True))
        if len(self.hash) + len(hashes) > self.memory:
            self._forget()
        new = np.flatnonzero(~self._known(hashes)[1])
        if len(new):
            new = new[np.argsort(hashes[new])]
            first = np.zeros(len(hashes), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            raw, at = data.tobytes(), first[new]
            self._learn(hashes[new], [raw[a:b].decode() for a, b in zip(w.start[at].tolist(), w.end[at].tolist())])
        at = self._known(hashes)[0][codes] if len(hashes) else np.zeros(0, np.int64)
        length = self.length[at].astype(np.int64)
        ids = self.pool[spread(self.start[at], length)] if len(at) else np.zeros(0, np.uint32)
        offsets = np.append(0, np.cumsum(length))[w.first]
        if own:
            parts = [own[i] if i in own else ids[offsets[i]:offsets[i + 1]] for i in range(len(column))]
            ids = np.concatenate(parts)
            offsets = np.append(0, np.cumsum([len(p) for p in parts]))
        return ids, offsets


def word_ids(path: str) -> WordIds:
    return cached(("word-ids", path), lambda: WordIds(path))
