"""Near copies of embeddings by an inverted multi-index (operator 3).

Vectors are normalised and cut into halves; each half has its own codebook,
and the two codes of a vector name its cell in the product grid. A query
visits the grid's cells in the order of growing distance of the codes in the
two halves (the multi-sequence order) up to a bound. The bound comes from
the target recall: neighbours at exactly the threshold are drawn around a
sample of vectors, and the bound is the distance at which that share of
them is reached. Whatever shares a cell is verified by its cosine in double
precision.

Equal vectors are one representative. A cell with many vectors is dealt into
blocks that its visitors meet one by one, so a task holds one block. A block
reports how many links each visitor has, and of the links themselves only a
spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import frugal, written
from wikipassages.llm.components import connected_components

#: Most vectors of a block.
BLOCK = 4096
#: Cells aimed at: one for so many vectors.
PER_CELL = 256
_STEP = 1 << 21


@dataclass
class Index:
    dim: int
    left: np.ndarray      # codebook of the first half
    right: np.ndarray
    bound: float          # cells are visited up to this excess of squared distance

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.dim // 2
        return tuple(np.maximum(0, (p * p).sum(1)[:, None] - 2 * p @ c.T + (c * c).sum(1)[None, :])
                     for p, c in ((x[:, :half], self.left), (x[:, half:], self.right)))

    def home(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.right) + b.argmin(1)

    def visited(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all visits, row by row along the staircase of the two sorted sequences."""
        a, b = self.distances(x)
        by_a, by_b = a.argsort(1), b.argsort(1)
        a = np.take_along_axis(a, by_a, 1)
        b = np.take_along_axis(b, by_b, 1)
        a, b = a - a[:, :1], b - b[:, :1]
        rows, cells = [], []
        for i in range(a.shape[1]):
            live = np.flatnonzero(a[:, i] <= self.bound)
            if not len(live):
                break
            reach = b[live] <= (self.bound - a[live, i])[:, None]
            row, j = np.nonzero(reach)
            rows.append(live[row])
            cells.append(by_a[live[row], i] * len(self.right) + by_b[live[row], j])
        return np.concatenate(rows), np.concatenate(cells)


    def excess(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each half's centres lie farther off than the nearest one."""
        a, b = self.distances(x)
        return a - a.min(1, keepdims=True), b - b.min(1, keepdims=True)


def _codebook(x: np.ndarray, size: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:size]].copy()
    for _ in range(rounds):
        nearest = ((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]).argmin(1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return np.unique(centres, axis=0)      # equal centres would leave a vector's own cell open


def fit(sample: np.ndarray, total: int, cosine: float, recall: float, seed: int = 11) -> Index:
    """An index for ``total`` unit vectors from a sample of them."""
    rng = np.random.Generator(np.random.PCG64(seed))
    half = sample.shape[1] // 2
    size = max(1, min(len(sample), math.ceil(math.sqrt(total / PER_CELL))))
    index = Index(sample.shape[1], _codebook(sample[:, :half], size, rng), _codebook(sample[:, half:], size, rng), 0.0)
    x = sample[rng.integers(0, len(sample), max(2000, len(sample)))]
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    length = np.linalg.norm(noise, axis=1, keepdims=True)
    y = cosine * x + math.sqrt(1 - cosine ** 2) * np.divide(noise, length, out=np.zeros_like(noise), where=length > 0)
    (a, b), (c, d) = index.distances(x), index.distances(y)
    rows = np.arange(len(x))
    excess = a[rows, c.argmin(1)] - a.min(1) + b[rows, d.argmin(1)] - b.min(1)
    index.bound = float(np.quantile(excess, recall)) + 1e-9
    return index


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision from a column of equally long lists."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _routed(batches: Iterator[pa.RecordBatch], index: Index, visits: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            x = _matrix(part.column("vector"))
            rows, cells = index.visited(x) if visits else (np.arange(len(x)), index.home(x))
            yield pa.RecordBatch.from_arrays([pa.array(cells), part.column("rep").take(pa.array(rows))], ["cell", "rep"])


def _linked(batches: Iterator[pa.RecordBatch], cosine: float, index: Index) -> Iterator[pa.RecordBatch]:
    """For rows sorted by (cell, block, visits): each visitor's links in the block, and a forest of them.

    Output rows: (rep, n_links, other): n_links counts vectors (0 on rows that only add a forest link).
    A visitor counts its links; where the vector that it finds does not visit the visitor's own cell in
    turn, the link is counted for that vector here, too, so both ends count each link that is found once.
    """
    key, ids, weights, homes, roots, off = None, [], [], [], None, None
    for batch in batches:
        cells, blocks, visits, reps, copies = (batch.column(c).to_numpy() for c in ("cell", "block", "visits", "rep", "copies"))
        cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(blocks) != 0) | (np.diff(visits) != 0)) + 1
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
            if lo == hi:
                continue
            if key != (cells[lo], blocks[lo]):
                key, ids, weights, homes, roots = (cells[lo], blocks[lo]), [], [], [], None
            x = _matrix(batch.column("vector").slice(lo, hi - lo))
            if visits[lo] == 0:
                ids.append(reps[lo:hi])
                weights.append(copies[lo:hi])
                homes.append(x)
                continue
            if not homes:
                continue
            if len(homes) > 1 or roots is None:
                ids, weights, homes = [np.concatenate(ids)], [np.concatenate(weights)], [np.concatenate(homes)]
                roots = np.arange(len(ids[0]))
                off = index.excess(homes[0])
            own = index.home(x)
            step = max(1, _STEP // len(ids[0]))
            for a in range(0, hi - lo, step):
                near = x[a:a + step] @ homes[0].T >= cosine
                mine = reps[lo + a:lo + a + len(near)]
                n = near @ weights[0]
                found = np.flatnonzero(n > 0)
                row, col = np.nonzero(near)
                cell = own[a + row]
                one_way = off[1][col, cell % len(index.right)] > index.bound - off[0][col, cell // len(index.right)]
                back = np.bincount(col[one_way], copies[lo + a + row[one_way]], len(ids[0])).astype(np.int64)
                found_back = np.flatnonzero(back)
                out.append((ids[0][found_back], back[found_back], np.full(len(found_back), -1)))
                left, right = [], []
                others = near & (ids[0][None, :] != mine[:, None])
                for i in np.flatnonzero(others.any(1)).tolist():
                    linked = np.flatnonzero(others[i])
                    trees, first = np.unique(roots[linked], return_index=True)
                    left += [mine[i]] * len(trees)
                    right += ids[0][linked[first]].tolist()
                    if len(trees) > 1:
                        roots[np.isin(roots, trees)] = trees[0]
                out.append((mine[found], n[found].astype(np.int64), np.full(len(found), -1)))
                if left:
                    out.append((np.array(left, np.int64), np.zeros(len(left), np.int64), np.array(right, np.int64)))
        if out:
            a, n, b = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(n), pa.array(b, mask=n > 0)], ["rep", "n_links", "other"])


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` finite components, not all zero."""
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == dim) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def near_copies(df: DataFrame, vec: str = "vec_id", embedding: str = "embedding", cosine: float = 0.9, recall: float = 0.9995,
                sample: int = 20_000) -> DataFrame:
    """(vec, n_links, component_id, kept) for every row of ``df``.

    Two vectors are linked if their cosine, in double precision, is at least
    ``cosine``; every link given is verified, and counted at both of its ends. ``recall``: share of neighbours
    at exactly the threshold whose cell is visited, by the calibration on at
    most ``sample`` vectors (chosen by the hash of their id), which also give
    the codebooks; all vectors are indexed and all are queries. Null, zero and
    non-finite vectors and those of another than the most frequent length
    link with nothing; a null id is linked with nothing and in no component.
    Rows of one id are one vector; a copy under another id is a link.
    """
    rows = df.select(F.col(vec).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("vector"))
    alone = rows.select(F.col("id").alias(vec), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    most = rows.where("id is not null and vector is not null").groupBy(F.size("vector").alias("dim")) \
        .agg(F.count("*").alias("n")).where("dim > 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return alone
    dim = int(most["dim"])
    vectors = rows.where(F.col("id").isNotNull() & usable(F.col("vector"), dim))
    members = written(vectors.groupBy("vector").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("copies")), "distinct-vectors")
    taken = members.select("vector").orderBy(F.xxhash64("rep"), "rep").limit(sample).toArrow()        # the bounded sample
    if not taken.num_rows:
        return alone
    index = fit(_matrix(taken.column("vector").combine_chunks()), members.count(), cosine, recall)

    schema = "cell bigint, rep bigint"
    homes = written(members.mapInArrow(frugal(lambda b: _routed(b, index, False)), schema), "homes")
    blocks = homes.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    visits = members.mapInArrow(frugal(lambda b: _routed(b, index, True)), schema).join(blocks, "cell") \
        .select("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), "rep", F.lit(1).alias("visits"))
    homes = homes.join(blocks, "cell").select("cell", F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block"), "rep", F.lit(0).alias("visits"))
    meeting = homes.union(visits).join(members, "rep").select("cell", "block", "visits", "rep", "copies", "vector")
    found = meeting.repartition("cell", "block").sortWithinPartitions("cell", "block", "visits") \
        .mapInArrow(frugal(lambda b: _linked(b, cosine, index)), "rep bigint, n_links bigint, other bigint")
    found = written(found, "found-links")
    parts = connected_components(found.where("other is not null"), "rep", "other").withColumnRenamed("id", "rep")
    counts = found.groupBy("rep").agg(F.sum("n_links").alias("n"))
    result = members.join(counts, "rep", "left").join(parts, "rep", "left") \
        .select("vector", (F.coalesce("n", F.lit(1)) - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    keyed = rows.withColumn("__ok", usable(F.col("vector"), dim) & F.col("id").isNotNull()) \
        .withColumn("__key", F.when(F.col("__ok"), F.col("vector")))
    return keyed.join(result.withColumnRenamed("vector", "__vector"), F.col("__key") == F.col("__vector"), "left").select(
        F.col("id").alias(vec), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col(vec) == F.col("component_id"), F.lit(True)))
