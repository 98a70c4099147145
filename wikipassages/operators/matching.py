"""Clauses that documents meet, scored in the tasks where their postings lie (Q5-Q8).

A prefix, a pattern or a misspelt term can mean a large part of the dictionary, and a document meets many clauses of
many queries. Neither fits well into rows: a broadcast of the terms grows with the vocabulary, and a row for each
(document, clause) and (document, query) is made only to be added up. So:

* postings lie in **parts** of the documents, and each part has its own small dictionary (``SearchIndex.parts``).
  The clauses of a term travel to the parts whose documents hold it, by an ordinary shuffle of the dictionary.
* a task meets the postings of one part with these lists and adds up in NumPy, some documents at a time: which
  clauses a document meets, the sum of their gains, and from these the scores of all queries.
* with ``best``, only what can be among the best hits of a query leaves the task.

What the queries ask (a row for each clause of each query) goes along with the function, as query tables do elsewhere.
"""

from __future__ import annotations

import ctypes
import sys
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# The functions that run inside tasks are shipped by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: (posting, clause) pairs and (document, clause) cells that one step takes; a document is never divided.
STEP_PAIRS, STEP_CELLS = 1 << 17, 1 << 19
#: Scores are rounded to six places before they are ranked.
SLACK = 2e-6
#: Candidates that a task holds before it drops those that others have overtaken.
HELD = 50_000


# ---------------------------------------------------------------- parts of documents
@cache
def _labels(spark: SparkSession, n: int) -> tuple[int, ...]:
    """A number for each of ``n`` buckets that Spark's hash puts into this bucket."""
    found = spark.range(40 * n + 400).select(F.col("id").cast("int").alias("label")) \
        .groupBy(F.pmod(F.hash("label"), F.lit(n)).alias("bucket")).agg(F.min("label").alias("label")).collect()
    by_bucket = {r["bucket"]: r["label"] for r in found}
    return tuple(by_bucket.get(b, 40 * n + 400 + b) for b in range(n))


def part_of(spark: SparkSession, n: int, doc_id: str = "doc_id") -> Column:
    """The part of a document, of ``n``: documents of one hash bucket are one part, and each part has a bucket of its own."""
    return F.element_at(F.array(*map(F.lit, _labels(spark, n))), F.pmod(F.hash(doc_id), F.lit(n)) + 1)


# ---------------------------------------------------------------- scores from met clauses
@dataclass
class Sums:
    """Scores that are sums over a query's clauses; a row of the arrays for each clause of a query, sorted by query.

    ``score = sum(gain * s) / norm * hits / clauses`` (``squared``: ``hits^2 / norm``), where ``hits`` adds ``count``
    of the clauses met; a document needs as many ``must`` clauses as the query has, and no ``forbidden`` one.
    """

    queries: list                                    # of each column of scores
    starts: np.ndarray
    cids: np.ndarray
    count: np.ndarray
    norm: np.ndarray
    clauses: np.ndarray
    gain: np.ndarray | None = None
    must: np.ndarray | None = None
    forbidden: np.ndarray | None = None
    musts: np.ndarray | None = None

    def __call__(self, s: np.ndarray | None, met: np.ndarray) -> np.ndarray:
        here = met[:, self.cids]

        def total(x):
            return np.add.reduceat(x, self.starts, axis=1)

        hits = total(here * self.count)
        if self.gain is None:
            score = hits * hits / self.norm
        else:
            raw = total(s[:, self.cids] * self.gain)
            score = np.divide(raw, self.norm, out=np.zeros_like(raw), where=self.norm > 0) * hits / np.maximum(self.clauses, 1)
        ok = hits > 0
        if self.must is not None:
            ok &= (total(here * self.must) == self.musts) & (total(here * self.forbidden) == 0)
        return np.where(ok, score, -np.inf)


@dataclass
class Level:
    """Nodes of one depth of the trees, sorted by parent: their columns, what they are to it, and the parents."""

    nodes: np.ndarray
    starts: np.ndarray
    scoring: np.ndarray
    must: np.ndarray
    parents: np.ndarray
    boost: np.ndarray
    clauses: np.ndarray
    musts: np.ndarray


@dataclass
class Trees:
    """Scores of trees of clauses (``clauses.grouped_scores``): leaves first, then level by level up to the roots."""

    queries: list
    size: int
    leaves: np.ndarray                               # columns of the leaves, and their clauses and boosts
    cids: np.ndarray
    boost: np.ndarray
    levels: list = field(default_factory=list)       # the deepest first
    roots: np.ndarray | None = None
    norm: np.ndarray | None = None
    gain = True

    def __call__(self, s: np.ndarray, met: np.ndarray) -> np.ndarray:
        value, there = np.zeros((len(met), self.size)), np.zeros((len(met), self.size), bool)
        value[:, self.leaves] = s[:, self.cids] * self.boost
        there[:, self.leaves] = met[:, self.cids]
        for at in self.levels:
            here, m = there[:, at.nodes], value[:, at.nodes]

            def total(x, starts=at.starts):
                return np.add.reduceat(x, starts, axis=1)

            hits = total((here & at.scoring).astype(np.int32))
            holds = (hits > 0) & (total((here & at.must).astype(np.int32)) == at.musts) & (total((here & ~at.scoring).astype(np.int32)) == 0)
            value[:, at.parents] = total(np.where(here & at.scoring, m, 0.0)) * at.boost * hits / np.maximum(at.clauses, 1)
            there[:, at.parents] = holds
        root = value[:, self.roots]
        return np.where(there[:, self.roots], np.divide(root, self.norm, out=np.zeros_like(root), where=self.norm > 0), -np.inf)


# ---------------------------------------------------------------- in a task
def _best(col: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Which candidates can be among the best ``k`` of their column once scores are rounded; ties go to the smaller document."""
    order = np.lexsort((doc, -score, col))
    c, s = col[order], score[order]
    n = np.arange(len(order))
    first = np.r_[True, c[1:] != c[:-1]]
    start = np.flatnonzero(first)[np.cumsum(first) - 1]
    last = np.minimum(start + k - 1, np.r_[np.flatnonzero(first)[1:], len(order)][np.cumsum(first) - 1] - 1)
    run = first | np.r_[True, s[1:] != s[:-1]]
    equal = n - np.flatnonzero(run)[np.cumsum(run) - 1]
    return order[(n - start < k) | ((s >= s[last] - SLACK) & (equal < k))]


def _key(table: pa.Table, several: bool) -> pa.ChunkedArray:
    return pc.binary_join_element_wise(table["field"], table["term"], "\u0000") if several else table["term"]


def part_scores(postings: pa.Table, lists: pa.Table, scores, n_clauses: int, constant: np.ndarray | None, several: bool, k: int | None):
    """Column, document and score of what the documents of one part reach.

    ``lists``: ``field, term, cids[, gains]``; a row without a field is a document (``term``) that meets the clauses as it is.
    """
    none = np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0)
    whole = pc.is_null(lists["field"])
    met_whole, lists = lists.filter(whole), pa.concat_tables([lists.filter(pc.invert(whole)), lists.filter(whole)])
    n_lists = len(lists) - len(met_whole)
    at = pc.index_in(_key(postings, several), value_set=_key(lists.slice(0, n_lists), several).combine_chunks())
    postings = postings.append_column("at", at).filter(pc.is_valid(at))
    if not len(postings) + len(met_whole):
        return none
    docs = pa.chunked_array([*postings["doc_id"].chunks, *met_whole["term"].chunks], pa.string())
    names = pc.unique(docs)
    names = names.take(pc.array_sort_indices(names, null_placement="at_start"))
    doc = pc.index_in(docs, value_set=names).to_numpy()
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    at = np.r_[postings["at"].to_numpy(), np.arange(n_lists, len(lists), dtype=np.int32)][order]
    weight = np.sqrt(postings["tf"].to_numpy().astype(float)) / np.sqrt(postings["len"].to_numpy().astype(float))
    weight = np.r_[weight, np.ones(len(met_whole))][order]
    del postings, docs, order

    sizes = pc.list_value_length(lists["cids"]).to_numpy().astype(np.int64)
    first = np.cumsum(sizes) - sizes
    cids = pc.list_flatten(lists["cids"]).to_numpy()
    gains = pc.list_flatten(lists["gains"]).to_numpy() if scores.gain is not None else None
    counts = sizes[at]
    ends = np.cumsum(counts)                                                   # pairs up to each posting
    bounds = np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)]   # first posting of each document
    pairs = np.r_[0, ends][bounds]
    most_docs = max(1, STEP_CELLS // max(n_clauses, len(scores.queries), getattr(scores, "size", 0), len(scores.cids)))

    found, held, least = [], 0, np.full(len(scores.queries), -np.inf)
    d = 0
    while d < len(names):
        e = min(max(d + 1, int(np.searchsorted(pairs, pairs[d] + STEP_PAIRS, side="right")) - 1), d + most_docs, len(names))
        lo, hi = bounds[d], bounds[e]
        c = counts[lo:hi]
        place = np.repeat(first[at[lo:hi]] - (ends[lo:hi] - c) + pairs[d], c) + np.arange(pairs[e] - pairs[d])
        cell = np.repeat((doc[lo:hi] - d).astype(np.int64) * n_clauses, c) + cids[place]
        met = np.zeros((e - d) * n_clauses, bool)
        met[cell] = True
        met, s = met.reshape(e - d, n_clauses), None
        if gains is not None:
            s = np.bincount(cell, np.repeat(weight[lo:hi], c) * gains[place], (e - d) * n_clauses).reshape(e - d, n_clauses)
            if constant is not None:
                s[:, constant] = met[:, constant]
        reached = scores(s, met)
        # documents come in their order: one that only equals the k-th best so far is behind it
        row, col = np.nonzero(reached > least)
        found.append((col, row + d, reached[row, col]))
        held += len(col)
        d = e
        if k is not None and held > HELD:
            found, held, least = _dropped(found, least, k)
    if k is not None:
        found, held, least = _dropped(found, least, k)
    col, row, score = (np.concatenate([f[i] for f in found]) for i in range(3))
    return col, names.take(pa.array(row)), score


def _dropped(found: list, least: np.ndarray, k: int) -> tuple[list, int, np.ndarray]:
    """The candidates that are left, how many are new before the next time, and each column's k-th best score."""
    col, row, score = (np.concatenate([f[i] for f in found]) for i in range(3))
    if not len(col):
        return [(col, row, score)], 0, least
    keep = _best(col, row, score, k)
    col, row, score = col[keep], row[keep], score[keep]
    first = np.flatnonzero(np.r_[True, col[1:] != col[:-1]])
    size = np.diff(np.r_[first, len(col)])
    least = least.copy()
    full = size >= k
    least[col[first[full]]] = score[first[full] + k - 1]
    return [(col, row, score)], 0, least


def _release() -> None:
    """Gives memory that the part took back to the machine, beside the JVM's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# ---------------------------------------------------------------- the job
def scored(index, terms: DataFrame, fields: list[str], scores, n_clauses: int, query_type, best: int | None = None,
           constant: np.ndarray | None = None, extra: DataFrame | None = None) -> DataFrame:
    """``query_id, doc_id, score`` of the documents of an index with ``parts``.

    ``terms``: ``cid, field, term`` and ``gain`` if ``scores`` adds gains, one row for each clause and term; ``extra``:
    ``doc_id, cid, m`` of clauses that were met elsewhere. With ``best``, hits that cannot be among so many of their
    query's first are left out.
    """
    gained = scores.gain is not None
    given = F.struct("cid", F.coalesce("gain", F.lit(0.0)).alias("gain")) if gained else F.struct("cid")
    lists = terms.groupBy("field", "term").agg(F.collect_list(given).alias("c")) \
        .select("field", "term", F.col("c.cid").alias("cids"), *([F.col("c.gain").alias("gains")] if gained else []))
    lists = index.parts.where(F.col("field").isin(fields)).select("part", "field", "term").join(lists, ["field", "term"]).select("part", *lists.columns)
    if extra is not None:
        whole = extra.select(index.part_of.alias("part"), F.lit(None).cast("string").alias("field"), F.col("doc_id").alias("term"),
                             F.array("cid").alias("cids"), F.array("m").alias("gains"))
        lists = lists.unionByName(whole)
    several = len(fields) > 1
    postings = index.postings.where(F.col("field").isin(fields)).select("part", *(["field"] if several else []), "term", "doc_id", "tf", "len")
    queries, id_type = list(scores.queries), query_type

    def of_part(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_type
        kind = to_arrow_type(id_type)
        if not right.num_rows:
            col, doc, score = np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0)
        else:
            col, doc, score = part_scores(left, right, scores, n_clauses, constant, several, best)
        doc = doc.combine_chunks() if isinstance(doc, pa.ChunkedArray) else doc
        out = pa.table({"query_id": pa.array(queries, kind).take(pa.array(col)), "doc_id": doc, "score": pa.array(score)})
        _release()
        return out

    out = StructType([StructField("query_id", query_type), StructField("doc_id", StringType()), StructField("score", DoubleType())])
    return postings.groupBy("part").cogroup(lists.groupBy("part")).applyInArrow(of_part, out)
