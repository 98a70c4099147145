"""Filter interaction audit over sorted posting lists (operator 12).

Every filter of a chain keeps, for each part and id range, the sorted list
of the ids that fail it. What a filter removes after some others is its list
without their union, so the figures of all orders of the filters come from
one union for each set of filters and one difference for each filter and set
not holding it; sizes are summed over the id ranges. Ids are row numbers given
here, so null and repeated document ids do no harm, and a range holds at
most ``RANGE`` rows whatever share of the table a part has.

Lists are merged by galloping: the shorter list's ids are searched in the
longer one, both ascending, so that each search goes on where the last ended
and ids in between are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import frugal, written

#: Bits of a row number within its id range.
RANGE_BITS = 16
RANGE = 1 << RANGE_BITS
#: Texts that make up one of so many rows or more are looked up in a broadcast table (of at most so many rows).
HOT_SHARE = 1000


# ---------------------------------------------------------------- sorted lists
def found_in(ids: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the ascending ``ids`` are in the ascending ``among``; the shorter gallops through the longer."""
    if not len(ids) or not len(among):
        return np.zeros(len(ids), bool)
    if len(ids) <= len(among):
        at = np.minimum(np.searchsorted(among, ids), len(among) - 1)
        return among[at] == ids
    at = np.minimum(np.searchsorted(ids, among), len(ids) - 1)
    out = np.zeros(len(ids), bool)
    out[at[ids[at] == among]] = True
    return out


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Ascending ids of all ``lists``: the shorter ones are merged into the longest."""
    merged, *others = sorted(lists, key=len, reverse=True)
    for ids in others:
        fresh = ids[~found_in(ids, merged)]
        merged = np.insert(merged, np.searchsorted(merged, fresh), fresh)
    return merged


def difference(ids: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """The ``ids`` that are in none of ``lists``."""
    for other in sorted(lists, key=len, reverse=True):
        ids = ids[~found_in(ids, other)]
    return ids


def sizes(failing: list[np.ndarray], marks: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, list[int]]]:
    """For each filter f and set S of others (a bit mask): f, S, size of S's union with f, of f's list without S's union,
    and how many of the latter are in each list of ``marks``."""
    k = len(failing)
    unions = [np.zeros(0, np.int64)]
    for s in range(1, 1 << k):
        top = s.bit_length() - 1
        unions.append(union([unions[s ^ (1 << top)], failing[top]]))
    for f in range(k):
        for s in range(1 << k):
            if not s >> f & 1:
                removed = difference(failing[f], [unions[s]])
                yield f, s, len(unions[s | 1 << f]), len(removed), [int(found_in(removed, m).sum()) for m in marks]


# ---------------------------------------------------------------- the filters of the contract
def text_filters(text: Column) -> dict[str, Column]:
    """A: under 200 words; B: under half of the words distinct; C: more than 3 % capitals; D: holds a symbol. Null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, "[ \\x09-\\x0D]+"), "")
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * F.regexp_count(t, F.lit("[A-Z]")) > 3 * F.length(t),
            "D": t.rlike("[#$%&*|]")}


def repeats(rows: DataFrame, key: str, doc_id: str, out: str) -> DataFrame:
    """``rows`` with ``out``: whether a row of smaller ``doc_id`` has the same ``key`` (false for a null id).

    Keys of a large group are told by a broadcast of at most ``HOT_SHARE`` rows, so no task gathers one.
    """
    groups = written(rows.groupBy(key).agg(F.min(doc_id).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1"), "audit-groups")
    total = rows.select(F.count(F.lit(1))).scalar()
    hot = F.col("__n") * HOT_SHARE >= total
    large = F.broadcast(groups.where(hot).select(key, "__first"))
    later = F.coalesce(F.col(doc_id) > F.col("__first"), F.lit(False)).alias(out)
    columns = [c for c in rows.columns if c != out]
    return rows.join(large, key).select(*columns, later).union(
        rows.join(large, key, "left_anti").join(groups.where(~hot).select(key, "__first"), key, "left").select(*columns, later))


# ---------------------------------------------------------------- audit
def posting_lists(rows: DataFrame, number: str, part: str, flags: list[str]) -> DataFrame:
    """One row for each part and id range: ``part, block, n`` and for each flag the ascending numbers of the rows that have it."""
    lists = [F.array_sort(F.collect_list(F.when(F.col(f), F.col(number)))).alias(f) for f in flags]
    return (rows.groupBy(F.col(part).alias("part"), F.shiftright(F.col(number), RANGE_BITS).alias("block"))
            .agg(F.count(F.lit(1)).alias("n"), *lists))


def audit(rows: DataFrame, filters: list[str], part: str, good: str, toxic: str) -> DataFrame:
    """The figures of every order of ``filters`` (boolean columns, true: the row fails), for each value of ``part``.

    One row for each part, order and step: ``kept`` after the step, ``removed`` in it, ``redundant`` (failing, but
    removed before), ``unique_fails`` (failing this filter only), ``good_lost`` and ``toxic_lost`` (removed here
    with that flag), ``shapley`` (removed by this filter, summed over all orders). Null flags count as false, a null part
    as the empty one; a table without rows has no part. There are k! orders of k filters: meant for a chain of a few.
    """
    spark, k = rows.sparkSession, len(filters)
    flags = [*filters, good, toxic]
    numbered = rows.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                           *[F.coalesce(F.col(f), F.lit(False)).alias(f"flag{i}") for i, f in enumerate(flags)],
                           F.monotonically_increasing_id().alias("number"))
    names = [f"flag{i}" for i in range(k + 2)]
    lists = posting_lists(written(numbered, "audit-rows"), "number", "part", names)
    schema = pa.schema([("part", pa.string()), ("n", pa.int64()), ("f", pa.int32()), ("s", pa.int32()), ("fails", pa.int64()),
                        ("united", pa.int64()), ("removed", pa.int64()), ("good_lost", pa.int64()), ("toxic_lost", pa.int64())])

    def merged(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                found = [batch.column(name)[row].values.to_numpy(zero_copy_only=False).astype(np.int64) for name in names]
                part_name, n = batch.column("part")[row].as_py(), batch.column("n")[row].as_py()
                yield pa.RecordBatch.from_pylist(
                    [{"part": part_name, "n": n, "f": f, "s": s, "fails": len(found[f]), "united": united, "removed": removed,
                      "good_lost": g, "toxic_lost": t} for f, s, united, removed, (g, t) in sizes(found[:k], found[k:])], schema)

    spark_schema = "part string, n long, f int, s int, fails long, united long, removed long, good_lost long, toxic_lost long"
    sums = lists.mapInArrow(frugal(merged), spark_schema).groupBy("part", "f", "s").agg(
        *[F.sum(c).alias(c) for c in ("n", "fails", "united", "removed", "good_lost", "toxic_lost")])
    # orders in which f comes right after exactly the set s
    ways = F.element_at(F.array(*[F.lit(factorial(m) * factorial(k - 1 - m)) for m in range(k)]), F.bit_count("s") + 1)
    rest = F.lit((1 << k) - 1).bitwiseXOR(F.expr("cast(shiftleft(1, f) as int)"))
    by_filter = sums.groupBy("part", "f").agg(F.sum(ways * F.col("removed")).alias("shapley"),
                                              F.max(F.when(F.col("s") == rest, F.col("removed"))).alias("unique_fails"))
    steps = [("".join(filters[i] for i in order), step + 1, f, sum(1 << i for i in order[:step]))
             for order in permutations(range(k)) for step, f in enumerate(order)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, f int, s int")
    return sums.join(by_filter, ["part", "f"]).join(orders, ["f", "s"]).select(
        "part", "filter_order", "step", (F.col("n") - F.col("united")).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


def audited_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters A to E (E: identical to the text of a smaller ``doc_id``) over ``doc_id, text, lang``.

    ``labels``: ``doc_id, quality, toxic``; of several rows with one id any that says so counts. Null texts are
    empty texts; further columns are not read. Texts are told apart by their SHA-256.
    """
    text = F.col("text")
    flagged = written(docs.select("doc_id", F.col("lang").alias("part"), *[c.alias(name) for name, c in text_filters(text).items()],
                                  F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)).alias("digest")), "audit-flags")
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = repeats(flagged, "digest", "doc_id", "E").drop("digest").join(marks, "doc_id", "left")
    return audit(rows, ["A", "B", "C", "D", "E"], "part", "good", "toxic")
