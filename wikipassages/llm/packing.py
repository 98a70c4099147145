"""Best-fit packing of token pieces into sequences in bulk steps (operator 8).

Pieces are range-sorted by length, longest first, and numbered within their
length. Pieces of one length are interchangeable for the matching, and so
are sequences with one gap: the sweep works on classes (length, how many)
and (gap, how many), at most ``capacity`` of each, whatever the number of
documents. Each step takes the longest waiting length, finds the successor
gap (the smallest that holds it), matches pieces and gaps of the two classes
by rank, as many as there are of both, updates the gaps and repeats; lengths
without a successor open sequences. A step is one line of the plan, an
interval of ranks; every piece then finds its sequence and offset from its
own length and rank, in parallel.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikipassages.llm.common import frugal, text_slices, written
from wikipassages.llm.rlz import spread
from wikipassages.llm.word_ids import word_ids

PLAN = ["length", "rank", "each", "sequence", "offset"]


def cut_pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int, doc: str = "doc_id", text: str = "text",
               with_ids: bool = True) -> DataFrame:
    """(doc, piece, start, length, ids_crc32, ids): each text's ids and ``end_id``, cut where longer than ``capacity``.

    Null and empty texts are one piece with the end id only. ``ids`` holds the
    piece's ids as little-endian unsigned 32-bit numbers; without ``with_ids`` there is no such column, and
    nothing of the texts' size leaves the tasks.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_ids(tokenizer)
        for rows in text_slices(batches, "text"):
            ids, offsets = codec.encode(rows.column("text"))
            ids = np.insert(ids, offsets[1:], end_id).astype("<u4")
            offsets = offsets + np.arange(len(offsets))
            size = np.diff(offsets)
            n = -(-size // capacity)
            piece = spread(np.zeros(len(n), np.int64), n)
            row = np.repeat(np.arange(len(n)), n)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            first = offsets[:-1][row] + start
            crc = [zlib.crc32(ids[a:a + k]) for a, k in zip(first.tolist(), length.tolist())]
            columns = [rows.column("doc").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                       pa.array(crc, pa.int64())]
            if with_ids:
                edges = np.append(first, offsets[-1]).astype(np.int32) * 4
                columns.append(pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids)]))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)])

    schema = "doc bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return df.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text")).mapInArrow(frugal(pieces), schema)


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Plan lines (length, first rank, pieces in each sequence, first sequence, offset) of best fit, longest first.

    From its first rank on, a line's pieces fill its sequences one after the
    other; the next line of the length begins at the next line's first rank.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)   # gap -> [(first sequence, how many)]
    sizes: list[int] = []                                        # gaps that occur, ascending
    plan: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def leave(gap: int, first: int, many: int) -> None:
        if gap and many:
            if not gaps[gap]:
                insort(sizes, gap)
            gaps[gap].append((first, many))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit a sequence of {capacity}")
        waiting, rank = counts[length], 0
        while waiting:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, many = gaps[gap].pop()
                if not gaps[gap]:
                    sizes.pop(at)
            else:
                gap, first = capacity, opened
                many = -(-waiting // (capacity // length))
                opened += many
            each = gap // length
            whole = min(many, waiting // each)
            if whole:
                plan.append((length, rank, each, first, capacity - gap))
                leave(gap - each * length, first, whole)
                rank, waiting = rank + whole * each, waiting - whole * each
            if whole < many and 0 < waiting < each:
                plan.append((length, rank, waiting, first + whole, capacity - gap))
                leave(gap - waiting * length, first + whole, 1)
                whole, rank, waiting = whole + 1, rank + waiting, 0
            leave(gap, first + whole, many - whole)
    return plan


def packed(pieces: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """``pieces`` with sequence_id and offset (replaced if there): best-fit decreasing, no gaps inside a sequence.

    ``order``: columns that settle ties between pieces of one length; the
    rest of the order is arbitrary. A null length or one outside
    1..capacity raises. At most ``capacity`` counts come to the driver.
    """
    tie = F.xxhash64(*order)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the partition and the rank within partition and length; rows come sorted by length."""
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("__length").to_numpy()
            new = np.append(True, size[1:] != size[:-1])
            begins = np.flatnonzero(new)
            rank = np.arange(len(size)) - begins[np.cumsum(new) - 1]
            if size[0] == last:
                head = begins[1] if len(begins) > 1 else len(size)
                rank[:head] += seen
            last, seen = size[-1], rank[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(size), part, np.int32)), pa.array(rank)],
                                             [*batch.schema.names, "__part", "__local"])

    # written first: the range sort reads its input twice, and pieces are dear to make
    kept = written(pieces.drop("sequence_id", "offset", "__length", "__part", "__local"), "pieces")
    rows = kept.withColumn("__length", F.when(F.col(length).isNull(), F.raise_error("a piece without a length")).otherwise(F.col(length)).cast("bigint"))
    rows = rows.repartitionByRange(F.desc("__length"), tie).sortWithinPartitions(F.desc("__length"), *order)
    schema = T.StructType([*rows.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__local", T.LongType())])
    rows = written(rows.mapInArrow(frugal(numbered), schema), "ranked-pieces")
    blocks = rows.groupBy("__length", "__part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("__length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = written(blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-blocks")
    counts = {r[0]: r[1] for r in blocks.groupBy("__length").agg(F.sum("n")).collect()}   # capacity rows at most
    plan = np.array(sweep(counts, capacity), np.int64).reshape(-1, len(PLAN))
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def placed(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        size, rank = lengths.to_numpy(), ranks.to_numpy()
        lo, hi = np.searchsorted(plan[:, 0], size, "left"), np.searchsorted(plan[:, 0], size, "right")
        top = int(plan[:, 1].max(initial=0)) + int(rank.max(initial=0)) + 1
        line = np.searchsorted(plan[:, 0] * top + plan[:, 1], size * top + rank, "right") - 1 if top < 1 << 50 else \
            np.array([a + np.searchsorted(plan[a:b, 1], r, "right") - 1 for a, b, r in zip(lo, hi, rank)])
        into = rank - plan[line, 1]
        return pa.StructArray.from_arrays([pa.array(plan[line, 3] + into // plan[line, 2]),
                                           pa.array(plan[line, 4] + into % plan[line, 2] * size)], ["sequence_id", "offset"])

    out = rows.join(blocks.select("__length", "__part", F.col("before").alias("__before")), ["__length", "__part"])
    out = out.withColumn("__place", placed(F.col("__length"), F.col("__local") + F.col("__before")))
    return out.select(*[F.col(c) for c in kept.columns], "__place.sequence_id", "__place.offset")
