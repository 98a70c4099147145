"""Byte-level BPE: encoding as a monoid tree reduction, decoding by concatenation (operator 1).

A text is cut into halves down to short leaves; each leaf is encoded on its
own, and neighbours are joined. Joining re-encodes a window around the seam
and widens it until what lies outside provably cannot change:

* Pieces. The pattern matches left to right and never looks behind, so the
  pieces of a suffix do not depend on what stands before it. A piece of the
  left side is final if the matcher never looked past the left side's end:
  it ends before that end (the character after it was seen) and does not
  start in the last two characters (contractions look at three). The window
  starts at the first piece that is not final. It may end where one of its
  own final pieces ends at a piece start of the right side: from there on
  the pieces are those of the right side.
* Merges. Inside one piece, a token sequence is the encoding of its bytes
  if every two neighbours encode to themselves, since the first merge across
  a seam would show in the run over those two tokens alone. So a piece longer
  than a leaf is encoded in halves, too: the window of tokens around the
  seam is re-encoded and widened until its outer neighbours agree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikipassages.llm.common import cached, release

#: Characters of a leaf of the text tree, and bytes of a leaf inside one piece.
LEAF_CHARS, LEAF_BYTES = 4096, 512


@dataclass
class Part:
    """The encoding of text[start:end]; from ``open`` on, more text to the right could change it."""
    start: int
    end: int
    ids: list[int]
    open: int
    settled: int  # how many ids stand before ``open``


class TreeCodec:
    """Encoder and decoder for one vocabulary of ranks and one splitting pattern."""

    def __init__(self, path: str, pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.pair_ok: dict[tuple[int, int], bool] = {}

    # -- inside one piece ---------------------------------------------------
    def merge(self, piece: bytes) -> list[int]:
        return self.core._core_bpe.encode_single_piece(piece)

    def agree(self, a: int, b: int) -> bool:
        """Whether the two tokens side by side stay as they are."""
        ok = self.pair_ok.get((a, b))
        if ok is None:
            if len(self.pair_ok) > 200_000:
                self.pair_ok.clear()
            ok = self.pair_ok[(a, b)] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return ok

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.agree(left[-1], right[0]):
            return left + right
        width = 1
        while True:
            width *= 2
            lo, hi = max(0, len(left) - width), min(len(right), width)
            window = self.merge(b"".join([self.bytes_of[t] for t in left[lo:] + right[:hi]]))
            if (lo == 0 or self.agree(left[lo - 1], window[0])) and \
                    (hi == len(right) or self.agree(window[-1], right[hi])):
                return left[:lo] + window + right[hi:]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Halves joined bottom-up, without recursion limits for very long pieces."""
        if len(piece) <= self.leaf_bytes:
            return self.merge(piece)
        parts = [self.merge(piece[i:i + self.leaf_bytes]) for i in range(0, len(piece), self.leaf_bytes)]
        while len(parts) > 1:
            parts = [self.join_tokens(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0]

    # -- whole texts --------------------------------------------------------
    def pieces(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
        return [m.span() for m in self.pattern.finditer(text[start:end])]

    def tokens(self, text: str, spans: list[tuple[int, int]]) -> list[int]:
        out: list[int] = []
        for a, b in spans:
            out += self.encode_piece(text[a:b].encode())
        return out

    @staticmethod
    def first_open(spans: list[tuple[int, int]], end: int) -> int:
        """Index of the first piece that text after ``end`` could change."""
        k = len(spans)
        while k and (spans[k - 1][1] >= end or spans[k - 1][0] + 3 > end):
            k -= 1
        return k

    def leaf(self, text: str, start: int, end: int) -> Part:
        spans = [(a + start, b + start) for a, b in self.pieces(text, start, end)]
        k = self.first_open(spans, end)
        opened = spans[k][0] if k < len(spans) else end
        ids = self.core.encode_ordinary(text[start:end])
        return Part(start, end, ids, opened, len(ids) - len(self.tokens(text, spans[k:])))

    def join(self, text: str, left: Part, right: Part) -> Part:
        """The part for both texts: re-encodes only a window around the seam."""
        width = 64
        while True:
            stop = min(right.end, right.start + width)
            whole = stop == right.end
            window = [(a + left.open, b + left.open) for a, b in self.pieces(text, left.open, stop)]
            own = [(a + right.start, b + right.start) for a, b in self.pieces(text, right.start, stop)]
            final = len(window) if whole else self.first_open(window, stop)
            own_final = len(own) if whole else self.first_open(own, stop)
            starts = {a: k for k, (a, _) in enumerate(own[:own_final + 1])} | ({right.end: len(own)} if whole else {})
            at = next((k for k in range(final) if window[k][1] in starts), None)
            if at is not None or whole:
                break
            width *= 4
        window, meet = window[:at + 1], window[at][1]
        own = own[:starts[meet]]
        tail = left.ids[left.settled:]
        if len(window) == 1 and len(own) == 1 and len(self.pieces(text, left.open, left.end)) == 1:
            # one piece across the seam: its halves' tokens are joined
            drop = right.ids if meet == right.end else right.ids[:len(self.tokens(text, own))]
            fresh, dropped = self.join_tokens(tail, drop), len(drop)
        else:
            dropped = len(right.ids) if meet == right.end else len(self.tokens(text, own))
            fresh = self.tokens(text, window)
        ids = left.ids[:left.settled] + fresh + right.ids[dropped:]
        if meet <= right.open:
            return Part(left.start, right.end, ids, right.open, left.settled + len(fresh) + right.settled - dropped)
        k = self.first_open(window, right.end)
        opened = window[k][0] if k < len(window) else right.end
        open_tokens = len(fresh) if k == 0 else len(self.tokens(text, window[k:]))
        return Part(left.start, right.end, ids, opened, len(ids) - open_tokens)

    def encode(self, text: str) -> list[int]:
        """Ids of a text by pairwise joins up a tree of leaves."""
        parts = [self.leaf(text, i, min(len(text), i + self.leaf_chars))
                 for i in range(0, len(text), self.leaf_chars)]
        while len(parts) > 1:
            parts = [self.join(text, *parts[i:i + 2]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0].ids if parts else []

    def decode(self, ids) -> bytes:
        """Bytes of the ids: leaves of ids are concatenated up the tree."""
        of = self.bytes_of.__getitem__
        parts = [b"".join(map(of, ids[i:i + self.leaf_chars])) for i in range(0, len(ids), self.leaf_chars)]
        while len(parts) > 1:
            parts = [b"".join(parts[i:i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _codec(path: str, pattern: str) -> TreeCodec:
    return cached(("bpe", path, pattern), lambda: TreeCodec(path, pattern))


def encode(text: Column, path: str, pattern: str) -> Column:
    """Column of token ids (array of int) of a string column; null and empty texts give an empty array.

    ``path``: rank file present on every machine; ``pattern``: how text is
    split before the merges. A text of any length is one row's work; its
    memory is a small multiple of the text.
    """
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path, pattern)
        for batch in batches:
            yield _lists([np.array(codec.encode(x.as_py() or ""), np.int32) for x in batch])
        release()
    return ids(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Column of bytes of an array-of-int column; null and empty arrays give no bytes.

    An id outside the vocabulary raises an error that names it.
    """
    @F.arrow_udf(T.BinaryType())
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path, pattern)
        for batch in batches:
            out = []
            for x in batch:
                values = (x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int32)).tolist()
                if values and not 0 <= min(values) <= max(values) < len(codec.bytes_of):
                    raise ValueError(f"no such token id: {min(values)} or {max(values)}")
                out.append(codec.decode(values))
            yield pa.array(out, pa.binary())
        release()
    return raw(ids)


def encoded(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with its token ids in column ``ids`` (replaced if there)."""
    return df.withColumn(ids, encode(F.col(text), path, pattern))
