"""Grouped clauses and terms near each other (Q5, Q6), over the index tables.

A grouped query is a tree: a table of nodes, whose leaves are clauses of any
kind and whose inner nodes are groups. The leaves' matches are dealt by
document; every level of the trees is one aggregation inside the same tasks,
from the leaves up, whatever the number of queries.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..session import ensure_checkpoint_dir
from . import matching
from .index import SearchIndex
from .search import MUST, MUST_NOT, SHOULD, _nothing, asked_positions, clause_matches, expanded_clauses, rarest_terms, scored_clauses

GROUP = "group"


# ---------------------------------------------------------------- trees of clauses
def leaf_paths(nodes: DataFrame) -> tuple[DataFrame, int]:
    """``query_id, clause_id, kind, field, value, value2, path`` of every leaf, and the greatest depth.

    ``path`` holds the nodes from the root (place 0) to the leaf: ``node_id,
    occur, boost, clauses, musts`` (the last two: a group's scoring and
    required children). One join for each level of the small node table;
    nodes that no root leads to are left out.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    scoring = F.col("occur") != MUST_NOT
    children = nodes.where("parent_id is not null").groupBy("query_id", F.col("parent_id").alias("node_id")) \
        .agg(F.count_if(scoring).alias("clauses"), F.count_if(F.col("occur") == MUST).alias("musts"))
    occur = F.when(F.col("parent_id").isNull(), SHOULD).otherwise(F.col("occur"))
    known = nodes.join(children, ["query_id", "node_id"], "left").select(
        "query_id", "node_id", "parent_id", "kind", "field", "value", "value2",
        F.struct("node_id", occur.alias("occur"), F.col("boost").cast("double").alias("boost"),
                 F.coalesce("clauses", F.lit(0)).alias("clauses"), F.coalesce("musts", F.lit(0)).alias("musts")).alias("own")).checkpoint()
    level = known.where("parent_id is null").withColumn("path", F.array("own"))
    leaves, depth = [], 0
    while True:
        leaves.append(level.where(F.col("kind") != GROUP))
        above = level.where(F.col("kind") == GROUP).select("query_id", F.col("node_id").alias("parent_id"), F.col("path").alias("above"))
        below = known.join(above, ["query_id", "parent_id"]).withColumn("path", F.concat("above", F.array("own"))) \
            .select(*level.columns).checkpoint()
        if below.isEmpty():
            break
        level, depth = below, depth + 1
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out.select("query_id", F.col("node_id").alias("clause_id"), "kind", "field", "value", "value2", "path"), depth


def _trees(known: list, leaves: list, sumsq: dict, depth: int) -> matching.Trees | None:
    """The trees as arrays. ``known``: ``query_id, depth, parent_id, node_id, occur, boost, clauses, musts`` of each node that leads
    to a leaf; ``leaves``: ``query_id, node_id, cid, boost``; ``sumsq`` of each query that has one."""
    known = sorted((r for r in known if r["query_id"] in sumsq), key=lambda r: (r["depth"], r["query_id"], r["parent_id"] or 0, r["node_id"]))
    column = {(r["query_id"], r["node_id"]): k for k, r in enumerate(known)}
    leaves = [r for r in leaves if (r["query_id"], r["node_id"]) in column]
    if not leaves:
        return None
    levels = []
    for d in range(depth, 0, -1):
        rows = [r for r in known if r["depth"] == d]
        above = [column[r["query_id"], r["parent_id"]] for r in rows]
        starts = [k for k, p in enumerate(above) if k == 0 or p != above[k - 1]]
        parents = [known[above[k]] for k in starts]
        if rows:
            levels.append(matching.Level(
                np.array([column[r["query_id"], r["node_id"]] for r in rows]), np.array(starts), np.array([r["occur"] != MUST_NOT for r in rows]),
                np.array([r["occur"] == MUST for r in rows]), np.array([above[k] for k in starts]),
                *(np.array([float(p[c]) for p in parents]) for c in ("boost", "clauses", "musts"))))
    roots = [k for k, r in enumerate(known) if r["depth"] == 0]
    queries = [known[k]["query_id"] for k in roots]
    return matching.Trees(queries, len(known), np.array([column[r["query_id"], r["node_id"]] for r in leaves]), np.array([r["cid"] for r in leaves]),
                          np.array([float(r["boost"]) for r in leaves]), levels, np.array(roots), np.sqrt([sumsq[q] for q in queries]))


def grouped_scores(index: SearchIndex, nodes: DataFrame, max_edits: int = 2, best: int | None = None) -> DataFrame:
    """Q5: queries with groups of clauses, as ``(a OR b) AND NOT (c AND d)``: ``query_id, doc_id, score``.

    ``nodes``: ``query_id, node_id, parent_id, kind, field, value, value2, occur,
    boost``; a root has no parent, a group has kind ``group``, every other kind
    is a leaf as in :func:`.search.mixed_scores` and scores as there. A group
    matches a document that matches all its must children, none of its
    must-not ones and at least one that is not must-not; one without children
    matches nothing. It scores ``boost * coord * sum(children's scores)``,
    ``coord = matching / all`` of its scoring children, and a query's score is
    its root's over ``sqrt(sum(w^2))`` of all leaves under no must-not node, w
    multiplied by the boosts above. Repeated node ids of a query are not allowed.
    ``best`` as for :func:`.search.clause_scores`.
    """
    leaves, depth = leaf_paths(nodes)
    leaves = leaves.checkpoint()
    ids = ["query_id", "clause_id"]
    matches = None
    if index.parts is None:
        parts, matches = clause_matches(index, leaves.drop("path"), max_edits)
    else:
        c = expanded_clauses(index, leaves.drop("path"), max_edits)
        parts = c.asked.join(c.parts, "cid").drop("cid")

    weight = F.coalesce("part", F.lit(0.0)) * F.aggregate("path", F.lit(1.0), lambda acc, p: acc * p["boost"])
    sumsq = leaves.join(parts, ids, "left").where(~F.exists("path", lambda p: p["occur"] == MUST_NOT)) \
        .groupBy("query_id").agg(F.sum(weight * weight).alias("sumsq"))

    # what the tree says of each node that leads to a leaf; rows hold numbers only
    above = F.transform("path", lambda p, i: F.struct(i.alias("depth"), F.get("path", i - 1)["node_id"].alias("parent_id"), p.alias("own")))
    known = leaves.select("query_id", F.inline(above)).select("query_id", "depth", "parent_id", "own.*").distinct().checkpoint()

    def at(d: int, *cols) -> DataFrame:
        return F.broadcast(known.where(F.col("depth") == d).select("query_id", "node_id", *cols))

    if matches is None:
        asked = c.asked.join(leaves.select(*ids, F.element_at("path", -1)["boost"].alias("boost")), ids) \
            .select("query_id", F.col("clause_id").alias("node_id"), "cid", "boost").collect()
        trees = _trees(known.collect(), asked, {r["query_id"]: float(r["sumsq"]) for r in sumsq.collect() if r["query_id"] is not None}, depth)
        return scored_clauses(index, c, trees, nodes.schema["query_id"].dataType, best) if trees else _nothing(nodes)

    boosts = leaves.select(*ids, F.element_at("path", -1)["boost"].alias("boost"))
    rows = matches.join(F.broadcast(boosts), ids).select("doc_id", "query_id", F.col("clause_id").alias("node_id"), (F.col("m") * F.col("boost")).alias("m"))
    for d in range(depth, 0, -1):
        # rows of level d are folded into their parents; those nearer to the root stay groups of their own
        deep, scoring = F.col("parent_id").isNotNull(), F.col("occur") != MUST_NOT
        folded = rows.join(at(d, "parent_id", "occur"), ["query_id", "node_id"], "left") \
            .groupBy("doc_id", "query_id", F.coalesce("parent_id", "node_id").alias("node_id")).agg(
                F.bool_or(deep).alias("folded"), F.sum(F.when(~deep | scoring, F.col("m"))).alias("m"), F.count_if(deep & scoring).alias("hits"),
                F.count_if(deep & (F.col("occur") == MUST)).alias("must_hits"), F.count_if(deep & ~scoring).alias("forbidden"))
        holds = (F.col("forbidden") == 0) & (F.col("must_hits") == F.col("musts")) & (F.col("hits") > 0)
        rows = folded.join(at(d - 1, "boost", "clauses", "musts"), ["query_id", "node_id"], "left").where(~F.col("folded") | holds).select(
            "doc_id", "query_id", "node_id", F.when(F.col("folded"), F.col("m") * F.col("boost") * F.col("hits") / F.col("clauses")).otherwise(F.col("m")).alias("m"))
    return rows.join(F.broadcast(sumsq), "query_id").select("query_id", "doc_id", (F.col("m") / F.sqrt("sumsq")).alias("score"))


# ---------------------------------------------------------------- terms near each other
def _least_windows(lists: Column, width: int) -> Column:
    """``freq, span`` of the smallest windows over sorted position lists, none longer than ``width``.

    One merge: for each position in order, the window that ends there begins
    at the smallest of every list's last position; it is a smallest one if
    that beginning has moved since the position before.
    """
    events = F.array_sort(F.flatten(F.transform(lists, lambda l, i: F.transform(l, lambda p: F.struct(p.alias("pos"), i.alias("i"))))))
    start = F.struct(F.transform(lists, lambda l: F.lit(-1)).alias("last"), F.lit(-1).alias("begin"),
                     F.lit(0).cast("bigint").alias("freq"), F.lit(None).cast("int").alias("span"))

    def step(acc: Column, e: Column) -> Column:
        moved = F.transform(acc["last"], lambda x, j: F.when(j == e["i"], e["pos"]).otherwise(x))

        def counted(last: Column) -> Column:
            begin = F.array_min(last)
            new = (begin > acc["begin"]) & (e["pos"] - begin <= width)
            return F.struct(last.alias("last"), begin.alias("begin"), F.when(new, acc["freq"] + 1).otherwise(acc["freq"]).alias("freq"),
                            F.when(new, F.least(acc["span"], e["pos"] - begin)).otherwise(acc["span"]).alias("span"))
        return let(moved, counted)

    return F.aggregate(events, start, step, lambda acc: F.struct(acc["freq"].alias("freq"), acc["span"].alias("span")))


def near_matches(index: SearchIndex, groups: DataFrame, width: int) -> DataFrame:
    """Q6: where all terms of a group stand near each other, in any order: ``query_id, phrase_id, doc_id, freq, span``.

    ``groups``: ``query_id, phrase_id, field, term`` (a repeated term counts
    once). ``freq`` is the number of smallest windows (windows of positions
    that hold every term and no smaller such window) whose last position is at most
    ``width`` behind their first one, ``span`` the least such distance. In a
    field of many values a window stands inside one value.

    Equal groups are looked up once. As for phrases, a group is looked for
    only in values that hold its rarest term, where their postings lie.
    """
    own = groups.groupBy("query_id", "phrase_id", "field").agg(F.array_sort(F.collect_set("term")).alias("terms")) \
        .withColumn("near", F.concat_ws(" ", "field", F.array_join("terms", " ")))
    asked = own.select("near", "field", "terms").distinct()
    parts = asked.select("near", "field", F.explode("terms").alias("term"))
    rarest = rarest_terms(index, parts, "near").join(asked.select("near", "terms"), "near")
    first = asked_positions(index, parts).select("field", *index.document, "held", F.explode("held.term").alias("term")).join(F.broadcast(rarest), ["field", "term"])
    lists = F.filter("held", lambda h: F.array_contains("terms", h["term"]))["positions"]
    whole = first.select("near", *index.document, "terms", lists.alias("lists")).where(F.size("lists") == F.size("terms"))
    windows = whole.select("near", *index.document, _least_windows(F.col("lists"), width).alias("w")).where("w.freq > 0") \
        .groupBy("near", *index.document).agg(F.sum("w.freq").alias("freq"), F.min("w.span").alias("span"))
    return windows.join(F.broadcast(own.select("query_id", "phrase_id", "near")), "near").select("query_id", "phrase_id", "doc_id", "freq", "span")
