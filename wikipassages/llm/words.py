"""Words of whole texts as flat NumPy arrays, hashed without a Python loop.

A word is a longest run of bytes other than space, tab, LF, VT, FF and CR.
Those bytes never occur inside a multi-byte UTF-8 character, so words of the
bytes are words of the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wikipassages.llm.common import cached

WHITE = b" \t\n\x0b\x0c\r"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 3)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_codes(seed: int, lower: bool) -> np.ndarray:
    codes = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, 256, dtype=np.uint64)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least the first ``n`` powers of the base and of its inverse, modulo 2**64; one table for the worker, grown as needed."""
    held = cached(("powers",), dict)
    if len(held.get("table", ((), ()))[0]) < n:
        size = ((n >> 18) + 1) << 18
        out = []
        for base in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        held["table"] = tuple(out)
    return held["table"]


@dataclass
class Words:
    data: np.ndarray       # bytes of all texts, one after the other
    docs: np.ndarray       # n + 1 byte offsets of the texts
    start: np.ndarray      # byte offsets of the words
    end: np.ndarray
    first: np.ndarray      # n + 1 offsets of the texts' words

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.docs) - 1), self.counts())

    def prefix(self, seed: int = 1, lower: bool = False) -> np.ndarray:
        """Running sums from which any byte range is hashed by ``hash_ranges``."""
        codes = cached(("codes", seed, lower), lambda: _byte_codes(seed, lower))
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(codes[self.data] * _powers(len(self.data) + 1)[0][:len(self.data)], out=sums[1:])
        return sums

    def hash_ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges; equal bytes give equal hashes wherever they stand."""
        return mix((prefix[end] - prefix[start]) * _powers(len(self.data) + 1)[1][start] + (end - start).astype(np.uint64))

    def hashes(self, seed: int = 1, lower: bool = False) -> np.ndarray:
        return self.hash_ranges(self.prefix(seed, lower), self.start, self.end)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its n + 1 offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8)[offsets[0]:offsets[-1]] if buffer else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words_of(column: pa.Array) -> Words:
    return words_from(*text_bytes(column))


def words_from(data: np.ndarray, docs: np.ndarray, white: bytes = WHITE) -> Words:
    """Words of texts given as bytes and offsets, separated by the bytes in ``white``."""
    separates = np.zeros(256, bool)
    separates[list(white)] = True
    inside = ~separates[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edge = docs[:-1][docs[:-1] < docs[1:]]
    before[edge] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[docs[1:][docs[:-1] < docs[1:]] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, docs, start, end, np.searchsorted(start, docs))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive word hashes (as if all texts were one: see ``inside_windows``)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
        out += hashes[k:k + n]
    return mix(out)


def inside_windows(words: Words, size: int) -> np.ndarray:
    """Which windows of ``window_hashes`` lie within one text."""
    n = len(words.start) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(words.first[1:], words.counts())[:n]
    return np.arange(n) + size <= last


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``size`` words that begins at one of ``starts``."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + size, n), minlength=n + 1)
    return np.cumsum(edges)[:n] > 0
