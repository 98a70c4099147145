"""Groups of clauses, terms near each other and ranges over dictionary blocks, against plain Python."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from wikipassages.operators import clauses as C
from wikipassages.operators import dictionary as D
from wikipassages.operators import index as I
from wikipassages.operators import search as Q

SCHEMA = "key string, page string, section string, n int, text string"
NODES = "query_id int, node_id int, parent_id int, kind string, field string, value string, value2 string, occur string, boost double"


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    return {f"p#{i}": " ".join(r.choice("ax bx cx dx ex fx gx".split()) for _ in range(r.randint(1, 14))) for i in range(60)}


@pytest.fixture(scope="module")
def index(spark, texts):
    return I.build_index(spark.createDataFrame([(k, "p", k[2:], 1, t) for k, t in texts.items()], SCHEMA))


def _node(query, node, parent, occur=Q.SHOULD, value=None, boost=1.0, kind=None):
    return (query, node, parent, kind or (Q.TERM if value else C.GROUP), I.DEFAULT_FIELD if value else None, value, None, occur, boost)


def _random_tree(r, query):
    nodes, numbers = [], itertools.count()

    def add(parent, depth, occur):
        node = next(numbers)
        boost = r.choice([0.5, 1.0, 2.0])
        if parent is not None and (depth == 3 or r.random() < 0.5):
            value = r.choice(["ax", "bx", "cx", "dx", "ex", "fx", "gx", "zz"])
            nodes.append(_node(query, node, parent, occur, value, boost))
            return
        nodes.append(_node(query, node, parent, occur, boost=boost))
        for _ in range(r.randint(0 if depth else 1, 3)):
            add(node, depth + 1, r.choice([Q.SHOULD, Q.SHOULD, Q.MUST, Q.MUST_NOT]))

    add(None, 0, Q.MUST)
    return nodes


def _expected(nodes, texts):
    words = {k: t.split() for k, t in texts.items()}
    idf = {w: 1 + math.log(len(words) / (sum(w in ws for ws in words.values()) + 1)) for w in ["ax", "bx", "cx", "dx", "ex", "fx", "gx", "zz"]}
    children = {}
    for n in nodes:
        children.setdefault(n[2], []).append(n)

    def score(node, ws):
        if node[3] == Q.TERM:
            tf = ws.count(node[5])
            return node[8] * math.sqrt(tf) / math.sqrt(len(ws)) * idf[node[5]] ** 2 if tf else None
        kids = [(k[7], score(k, ws)) for k in children.get(node[1], [])]
        scoring = [s for o, s in kids if o != Q.MUST_NOT]
        hits = [s for s in scoring if s is not None]
        if not hits or any(o == Q.MUST and s is None for o, s in kids) or any(o == Q.MUST_NOT and s is not None for o, s in kids):
            return None
        return node[8] * sum(hits) * len(hits) / len(scoring)

    def weights(node, boost):
        if node[3] == Q.TERM:
            return (boost * node[8] * idf[node[5]] if node[5] != "zz" else boost * node[8] * idf["zz"]) ** 2
        return sum(weights(k, boost * node[8]) for k in children.get(node[1], []) if k[7] != Q.MUST_NOT)

    root = children[None][0]
    return {k: s / math.sqrt(weights(root, 1.0)) for k, ws in words.items() if (s := score(root, ws)) is not None}


def test_random_trees(spark, index, texts):
    r = random.Random(11)
    trees = {q: _random_tree(r, q) for q in range(30)}
    trees[100] = [_node(100, 5, None, value="ax")]                                  # a leaf as the root
    trees[101] = [_node(101, 0, None), _node(101, 1, 9, value="ax")]                # a node that no root leads to
    got = C.grouped_scores(index, spark.createDataFrame([n for t in trees.values() for n in t], NODES)).collect()
    want = {(q, k): s for q, t in trees.items() for k, s in _expected(t, texts).items()}
    assert len(got) == len(want) > 100
    assert all(abs(g["score"] - want[g["query_id"], g["doc_id"]]) < 1e-9 for g in got)


def test_groups_with_other_kinds_and_empty_input(spark, index, texts):
    """``+(a* OR "bx cx") -(dx)``."""
    nodes = [_node(1, 0, None), _node(1, 1, 0, Q.MUST), _node(1, 2, 1, value="a", kind=Q.PREFIX), _node(1, 3, 1, value="bx cx", kind=Q.PHRASE),
             _node(1, 4, 0, Q.MUST_NOT), _node(1, 5, 4, value="dx")]
    got = {r["doc_id"] for r in C.grouped_scores(index, spark.createDataFrame(nodes, NODES)).collect()}
    assert got == {k for k, t in texts.items() if ("ax" in t or "bx cx" in t) and "dx" not in t}
    assert C.grouped_scores(index, spark.createDataFrame([], NODES)).count() == 0


def _windows(words, terms, width):
    at = [i for i, w in enumerate(words) if w in terms]
    full = [(a, b) for a in at for b in at if a <= b and set(words[a:b + 1]) >= terms]
    least = [(a, b) for a, b in full if not any((c, d) != (a, b) and a <= c and d <= b for c, d in full)]
    return [b - a for a, b in least if b - a <= width]


def test_near(spark, index, texts):
    groups = {(1, i): set(t) for i, t in enumerate([["ax"], ["ax", "bx"], ["cx", "dx", "ex"], ["ax", "zz"], ["fx", "gx", "ax", "bx"]])}
    groups[2, 0] = {"ax", "bx"}
    rows = [(q, p, I.DEFAULT_FIELD, t) for (q, p), ts in groups.items() for t in ts] + [(1, 1, I.DEFAULT_FIELD, "ax")]
    df = spark.createDataFrame(rows, "query_id int, phrase_id int, field string, term string")
    for width in (1, 4, 100):
        got = {(r["query_id"], r["phrase_id"], r["doc_id"]): (r["freq"], r["span"]) for r in C.near_matches(index, df, width).collect()}
        want = {(*g, k): (len(w), min(w)) for g, ts in groups.items() for k, t in texts.items() if (w := _windows(t.split(), ts, width))}
        assert got == want and want


def test_near_stays_inside_one_title(spark):
    secs = spark.createDataFrame([("p#a", "p", "a", 2, "word")], SCHEMA)
    index = I.build_index(secs, spark.createDataFrame([("p#a", "big cat"), ("p#a", "small dog")], "key string, redirect string"))
    groups = spark.createDataFrame([(1, 1, I.REDIRS_FIELD, t) for t in ("cat", "big")] + [(1, 2, I.REDIRS_FIELD, t) for t in ("cat", "dog")],
                                   "query_id int, phrase_id int, field string, term string")
    assert [(r["phrase_id"], r["freq"], r["span"]) for r in C.near_matches(index, groups, 50).collect()] == [(1, 1, 1)]


def test_ranges_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 8)
    r = random.Random(7)
    terms = {"".join(r.choice("aaabé\U0001F600z") for _ in range(r.randint(1, 6))) for _ in range(400)}
    stats = spark.createDataFrame([("t", t, 1) for t in terms] + [("u", "b", 1)], "field string, term string, df int")
    ends = [("a", "b"), ("a", "a"), ("", "\U0001F600"), ("zzzzzz", "~"), ("b", "a"), ("ab", "abz"), ("\U0001F600", "\U0001F600z"), ("", "")]
    ranges = spark.createDataFrame([("t", a, b) for a, b in ends] * 2 + [("u", "a", "c"), ("none", "a", "c")], "field string, lo string, hi string")
    blocks = D.term_blocks(stats, 5).checkpoint()
    sizes = blocks.groupBy("block").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 8 and sizes[1] >= len(terms) / 8
    want = {("t", a, b, t) for a, b in ends for t in terms if a.encode() <= t.encode() <= b.encode()} | {("u", "a", "c", "b")}
    for given in (blocks, None):
        got = [tuple(x) for x in D.terms_between(stats, ranges, given).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert D.terms_between(stats.limit(0), ranges).count() == 0
