"""Repeated passages by relative Lempel-Ziv parsing (operator 6).

Every document is a reference for the documents with larger ids. The index
of the references is cut into blocks by anchor: of the ``SEED``-word grams
inside a window of ``window`` words the one with the smallest hash is the
window's anchor, so equal windows have equal anchors and meet in one block
wherever they stand. A document is looked up in every block that holds one
of its anchors; what it finds there are phrases: runs of consecutive windows
that stand one after the other in the same earlier document, with the place
there. Parsing joins phrases that go on at their reference's next place, and
takes factors greedily, farthest first from the left; a factor is a stretch of
one reference, word by word, of at least ``window`` words. A window that
crosses the end of a factor is looked up like all others and may begin the
next factor, in another reference. The factors are the duplicate spans: a
word goes if a factor covers it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import frugal, text_slices
from wikipassages.llm.words import Words, inside_windows, mix, window_hashes, words_of

#: Words of an anchor.
SEED = 5
#: A window is known by 64 bits of its own; ``key`` only brings equal ones together. A follower's windows are all zero
#: and ``ref``, ``at`` (its leader's document and place there) are set; others have place -1 there.
#: The key is 32 bits of the anchor: two anchors that agree in them share a block, nothing else.
RUN = "key int, doc bigint, place bigint, windows binary, ref bigint, at int"
#: The runs of one slice for one bucket of keys in one row, each column as packed little-endian values of the type given
#: here: each text once, with the number of its runs, and of lengths and places the low bits apart, so that they pack well.
COLUMNS = {"docs": "<i8", "marks": "<i4", "counts": "<i4", "keys": "<i4", "near": "<u2", "far": "<i4", "short": "u1", "long": "<i4",
            "windows": "<u8", "refs": "<i8", "ats": "<i4"}
PACKED = "bucket int, " + ", ".join(f"{c} binary" for c in COLUMNS)
FOUND = "doc bigint, place bigint, n bigint, ref bigint, at int"


def runs_of(w: Words, window: int):
    """Runs of windows with one anchor: (anchor, first window, number of windows), and a hash of every window."""
    n = len(w.start) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none.astype(np.uint64)
    hashes = w.hashes()
    seed = min(SEED, window)
    seeds = window_hashes(hashes, seed)
    least = seeds[:n].copy()
    for k in range(1, window - seed + 1):
        np.minimum(least, seeds[k:n + k], out=least)
    at = np.flatnonzero(inside_windows(w, window))
    if not len(at):
        return none.astype(np.uint64), none, none, none.astype(np.uint64)
    text = w.doc_of_word()[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    length = np.diff(np.append(starts, len(at)))
    return least[at[starts]], at[starts], length, window_hashes(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), window)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each length, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def emitted_runs(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The rows that go to the blocks, for columns doc, mark (hash of the text) and text.

    Among equal runs of one slice only that of the smallest document goes to
    its block; the others are phrases of it already, so they travel under
    keys of their own and a passage that very many documents share does not
    fill one block.
    """
    for part in text_slices(batches, "text"):
        w = words_of(part.column("text"))
        anchor, first, length, hashes = runs_of(w, window)
        if not len(anchor):
            continue
        doc_at = w.doc_of_word()[first]
        doc = part.column("doc").to_numpy()[doc_at]
        place = (part.column("mark").to_numpy()[doc_at].astype(np.int64) << 32) | (first - w.first[doc_at])
        own = hashes[spread(first, length)]
        bounds = np.cumsum(length) - length
        whole = mix(np.add.reduceat(mix(own + spread(np.zeros(len(length), np.int64), length).astype(np.uint64)), bounds)
                    + anchor + length.astype(np.uint64))
        order = np.lexsort((place & 0xFFFFFFFF, doc, whole))
        head = np.ones(len(order), bool)
        head[1:] = whole[order[1:]] != whole[order[:-1]]
        leader = np.empty(len(order), np.int64)
        leader[order] = order[head][np.cumsum(head) - 1]
        follows = doc[leader] < doc
        key = np.where(follows, mix(whole + place.astype(np.uint64) + doc.astype(np.uint64)), anchor)
        # followers are found already: of their windows only the number counts
        raw = np.where(np.repeat(follows, length), np.uint64(0), own).astype("<u8")
        offsets = np.append(bounds, int(length.sum())) * 8
        key = (mix(key) >> np.uint64(32)).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([
            pa.array(key.view(np.int32)), pa.array(doc), pa.array(place), _binary(raw, offsets),
            pa.array(np.where(follows, doc[leader], 0)),
            pa.array(np.where(follows, place[leader] & 0xFFFFFFFF, -1).astype(np.int32))], ["key", "doc", "place", "windows", "ref", "at"])


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values from packed ``values``, cut at the byte ``offsets``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The packed values of a binary column and where each row's begin (in values)."""
    size = np.dtype(dtype).itemsize
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // size
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, dtype), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], dtype)[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def packed(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Runs to rows of ``PACKED``: one for each bucket of keys and batch."""
    for part in batches:
        key = part.column("key").to_numpy()
        bucket = (key.view(np.uint32) % np.uint32(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, place = bucket[order], part.column("place").to_numpy()[order]
        doc, mark = part.column("doc").to_numpy()[order], (place >> 32).astype("<i4")
        own, first = _values(part.column("windows"), "<u8")
        length = np.diff(first)[order]
        new = np.append(True, np.diff(bucket) != 0)
        text = np.flatnonzero(new | np.append(True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])))
        rows = np.append(np.flatnonzero(new), len(order))
        texts = np.append(np.searchsorted(text, rows[:-1]), len(text))
        values = {"docs": (doc[text], texts), "marks": (mark[text], texts), "counts": (np.diff(np.append(text, len(order))), texts),
                  "keys": (key[order], rows), "near": (place & 0xFFFF, rows), "far": ((place & 0xFFFFFFFF) >> 16, rows), "short": (length & 0xFF, rows),
                  "long": (length >> 8, rows), "windows": (own[spread(first[:-1][order], length)], np.append(0, np.cumsum(length))[rows]),
                  "refs": (part.column("ref").to_numpy()[order], rows), "ats": (part.column("at").to_numpy()[order], rows)}
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[rows[:-1]]), *(_binary(values[c][0].astype(t), values[c][1] * np.dtype(t).itemsize) for c, t in COLUMNS.items())],
            ["bucket", *COLUMNS])


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``PACKED`` to runs again, some 1 MB at a time."""
    for part in text_slices(batches, "windows"):
        v = {c: _values(part.column(c), t)[0] for c, t in COLUMNS.items()}
        length = v["short"] + (v["long"].astype(np.int64) << 8)
        mark = np.repeat(v["marks"], v["counts"]).astype(np.int64)
        place = (mark << 32) | (v["far"].astype(np.int64) << 16) | v["near"]
        yield pa.RecordBatch.from_arrays([
            pa.array(v["keys"]), pa.array(np.repeat(v["docs"], v["counts"])), pa.array(place),
            _binary(v["windows"], np.append(0, np.cumsum(length)) * 8), pa.array(v["refs"]), pa.array(v["ats"])],
            ["key", "doc", "place", "windows", "ref", "at"])


def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases (doc, place, n, ref, at) of a block's rows sorted by key, document and place.

    Of the rows seen so far only the last key's distinct windows are kept,
    each with the first document that holds it and its first place there.
    """
    last_key, last_hash, last_doc, last_at = None, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in batches:
        if not part.num_rows:
            continue
        key, doc, place, at_leader = (part.column(c).to_numpy() for c in ("key", "doc", "place", "at"))
        own, first = _values(part.column("windows"), "<u8")
        length = np.diff(first)
        ready = at_leader >= 0
        group = np.cumsum(np.append(False, key[1:] != key[:-1]))
        row = np.repeat(np.arange(len(key)), length)
        offset = spread(np.zeros(len(length), np.int64), length)
        tags, docs, groups, places = own, doc[row], group[row], (place[row] & 0xFFFFFFFF) + offset
        carried = len(last_hash) if last_key == key[0] else 0
        if carried:
            tags, docs, places = np.concatenate([last_hash, tags]), np.concatenate([last_doc, docs]), np.concatenate([last_at, places])
            groups = np.concatenate([np.zeros(carried, groups.dtype), groups])
        order = np.lexsort((tags, groups))
        head = np.ones(len(order), bool)
        head[1:] = (tags[order[1:]] != tags[order[:-1]]) | (groups[order[1:]] != groups[order[:-1]])
        firsts = order[head]
        source = np.empty(len(order), np.int64)
        source[order] = firsts[np.cumsum(head) - 1]
        ends_group = firsts[groups[firsts] == group[-1]]
        last_key, last_hash, last_doc, last_at = key[-1], tags[ends_group], docs[ends_group], places[ends_group]
        ref, at, docs = docs[source[carried:]], places[source[carried:]], docs[carried:]
        if ready.any():
            ref = np.where(ready[row], part.column("ref").to_numpy()[row], ref)
            at = np.where(ready[row], at_leader[row] + offset, at)
        found = ref < docs
        if not found.any():
            continue
        start = found.copy()
        start[1:] &= ~(found[:-1] & (row[1:] == row[:-1]) & (ref[1:] == ref[:-1]) & (at[1:] == at[:-1] + 1))
        begin = np.flatnonzero(start)
        n = np.add.reduceat(found.astype(np.int64), begin)
        yield pa.RecordBatch.from_arrays([pa.array(docs[begin]), pa.array(place[row[begin]] + offset[begin]), pa.array(n), pa.array(ref[begin]),
                                          pa.array(at[begin].astype(np.int32))], ["doc", "place", "n", "ref", "at"])


def phrases(docs: DataFrame, window: int) -> DataFrame:
    """(doc, mark, start, n, ref, at): windows start .. start + n - 1 of doc's text are at .. at + n - 1 of the earlier document ref.

    ``docs`` has columns doc, mark and text; rows with a null doc are in no relation to others.
    Runs travel packed, many to a row, and are sorted by Spark where they arrive.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = docs.where("doc is not null").select("doc", "mark", "text") \
        .mapInArrow(frugal(lambda b: packed(emitted_runs(b, window), buckets)), PACKED)
    found = runs.repartitionById(buckets, F.col("bucket")).mapInArrow(frugal(unpacked), RUN).sortWithinPartitions("key", "doc", "place") \
        .mapInArrow(frugal(looked_up), FOUND)
    return found.select("doc", F.shiftright("place", 32).cast("int").alias("mark"),
                        F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("start"),
                        F.col("n").cast("int").alias("n"), "ref", "at")


def factors(start: np.ndarray, n: np.ndarray, ref: np.ndarray, at: np.ndarray, window: int) -> list[dict]:
    """The greedy parse: from the left, always the factor that reaches farthest beyond what is covered.

    Phrases of one reference whose places go on without a gap are one; a
    factor's words are those of its windows, and equal the ``length`` words
    of ``ref`` from place ``at`` on.
    """
    order = np.lexsort((at, ref, start))
    joined: list[list[int]] = []
    reach: dict[tuple[int, int], list[int]] = {}
    for a, k, r, p in zip(start[order].tolist(), n[order].tolist(), ref[order].tolist(), at[order].tolist()):
        open_one = reach.get((r, p - a))
        if open_one is not None and open_one[1] >= a:
            open_one[1] = max(open_one[1], a + k)
        else:
            reach[r, p - a] = open_one = [a, a + k, r, p]
            joined.append(open_one)
    out: list[dict] = []
    end, i, best = -1, 0, None
    while i < len(joined) or best is not None:
        # candidates that begin inside or right after the covered words
        while i < len(joined) and (joined[i][0] <= end):
            if best is None or joined[i][1] > best[1]:
                best = joined[i]
            i += 1
        if best is not None and best[1] + window - 1 > end:
            out.append({"start": best[0], "length": best[1] - best[0] + window - 1, "ref": best[2], "at": best[3]})
            end, best = best[1] + window - 1, None
            continue
        best = None
        if i < len(joined):
            end = max(end, joined[i][0])
    return out


RESULT = "struct<n_words:bigint,n_removed:bigint,kept:string,factors:array<struct<start:int,length:int,ref:bigint,at:int>>>"


def _removed(window: int):
    @F.arrow_udf(RESULT)
    def removed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            out = []
            for text, spans in zip(texts, found):
                words = (text.as_py() or "").encode().split()
                if not spans.is_valid or not len(spans.values):
                    out.append({"n_words": len(words), "n_removed": 0, "kept": b" ".join(words).decode(), "factors": []})
                    continue
                parse = factors(*(spans.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "n", "ref", "at")), window)
                gone = np.zeros(len(words), bool)
                for f in parse:
                    gone[f["start"]:f["start"] + f["length"]] = True
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)]).decode()
                out.append({"n_words": len(words), "n_removed": int(gone.sum()), "kept": kept, "factors": parse})
            yield pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                                           ("factors", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref", pa.int64()), ("at", pa.int32())])))]))
    return removed


def parsed(df: DataFrame, doc: str = "doc_id", text: str = "text", window: int = 13, out: str = "parsed") -> DataFrame:
    """``df`` with struct column ``out``: n_words, n_removed, kept (words left, one space between), factors.

    A word goes if a window of ``window`` words that covers it also begins in
    a document with a smaller id. Null and empty texts have no words; rows
    with a null id keep all words and are nobody's reference; of rows with
    one id neither is earlier. Every input row is one output row.
    """
    marked = df.withColumn("__rlz_mark", F.xxhash64(text).bitwiseAND(0x7FFFFFFF).cast("int"))
    found = phrases(marked.select(F.col(doc).cast("bigint").alias("doc"), F.col("__rlz_mark").alias("mark"), F.col(text).alias("text")), window)
    spans = found.groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "n", "ref", "at")).alias("__rlz_spans")) \
        .select(F.col("doc").alias("__rlz_doc"), F.col("mark").alias("__rlz_same"), "__rlz_spans")
    both = marked.join(spans, (F.col(doc) == F.col("__rlz_doc")) & (F.col("__rlz_mark") == F.col("__rlz_same")), "left")
    return both.withColumn(out, _removed(window)(F.col(text), F.col("__rlz_spans"))) \
        .drop("__rlz_mark", "__rlz_doc", "__rlz_same", "__rlz_spans")
