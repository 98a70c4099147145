"""Clauses scored part by part in the tasks: the same hits as over loose postings, ties and prunings included."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wikipassages.operators import bounded, clauses as C, dictionary as D, matching
from wikipassages.operators import index as I
from wikipassages.operators import search as Q
from wikipassages.session import buckets, materialize

LETTERS = "aábcd"


@pytest.fixture(scope="module")
def indexes(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice(LETTERS) for _ in range(r.randint(1, 5)))
    words = [word() for _ in range(60)]
    rows = [(f"k{i}", f"p {r.choice(words)}", "s", 1, " ".join(r.choice(words) for _ in range(r.randint(0, 25)))) for i in range(120)]
    rows += [(f"t{i:02d}", "p", "s", 1, "aa ab ba") for i in range(30)] + [("k1", "p again", "s", 1, "aa bb"), (None, "p", "s", 1, "ab bb cc")]
    loose = I.build_index(spark.createDataFrame(rows, "key string, page string, section string, n int, text string"))
    part = matching.part_of(spark, buckets(spark))
    postings = materialize(spark, "test-matching", lambda: loose.postings.withColumn("part", part), bucket="part")
    parts = materialize(spark, "test-matching-parts", lambda: I.part_terms(postings))
    stats = parts.groupBy("field", "term").agg(F.sum("n").alias("df"))
    lying = I.SearchIndex(loose.docs, postings, stats, I.field_lengths(postings), by_document=True, parts=parts, part_of=part)
    return I.SearchIndex(loose.docs, loose.postings, loose.term_stats, loose.field_len), lying


def _terms(spark):
    return Q.query_terms(spark.createDataFrame([(1, "aa ab abc aa"), (2, "ba bb ca"), (3, "abcd aáb dd"), (4, "zz"), (5, "aa ab ba")], "query_id int, text string"))


CLAUSES = "query_id int, clause_id int, kind string, field string, value string, value2 string, occur string, boost double"


def _mixed(spark):
    rows, n = [], 0
    for q in (1, 2, 3):
        r = random.Random(q)
        for kind, value, value2 in ((Q.PREFIX, "a", None), (Q.WILDCARD, "*b*", None), (Q.RANGE, "b", "cd"), (Q.FUZZY, "abc", None), (Q.TERM, "dd", None),
                                    (Q.TERM, "ba", None), (Q.PHRASE, "aa ab", None), (Q.PREFIX, "d", None)):
            n += 1
            occur = {1: Q.MUST, 5: Q.MUST_NOT}.get(n % 8, Q.SHOULD)
            rows.append((q, n, kind, "sectionText" if kind != Q.TERM or q < 3 else "pageTitle", value, value2, occur, r.choice([0.5, 1.0, 2.0])))
    return spark.createDataFrame(rows, CLAUSES)


def _nodes(spark):
    out, f = [], "sectionText"
    for q in (1, 2):
        g = lambda node, parent, occur, boost: (q, node, parent, C.GROUP, None, None, None, occur, boost)
        leaf = lambda node, parent, kind, value, occur, boost=1.0: (q, node, parent, kind, f, value, None, occur, boost)
        out += [g(0, None, Q.SHOULD, 1.0), g(1, 0, Q.MUST if q == 1 else Q.SHOULD, 2.0), g(2, 0, Q.MUST_NOT, 1.0), g(3, 1, Q.SHOULD, 0.5), g(9, 0, Q.SHOULD, 1.0),
                leaf(4, 1, Q.PREFIX, "a", Q.SHOULD), leaf(5, 2, Q.TERM, "dd", Q.MUST), leaf(6, 2, Q.TERM, "ba", Q.MUST),
                leaf(7, 3, Q.FUZZY, "abb", Q.MUST), leaf(8, 3, Q.WILDCARD, "*c", Q.MUST_NOT), leaf(10, 0, Q.PHRASE, "aa ab", Q.SHOULD, 3.0)]
    out += [(3, 0, None, Q.TERM, f, "ab", None, Q.MUST, 2.0)]
    return spark.createDataFrame(out, "query_id int, node_id int, parent_id int, kind string, field string, value string, value2 string, occur string, boost double")


def _searches(spark, ix, best=None):
    terms = _terms(spark)
    one = terms.select("query_id", F.col("term").alias("clause_id"), "field", "term")
    more = {"best": best} if best else {}
    return {
        "prefix": Q.prefix_scores(ix, one.withColumn("prefix", F.substring("term", 1, 1)), **more),
        "wildcard": Q.shared_clause_scores(ix, one.select("query_id", "clause_id", "field", F.concat(F.lit("*"), F.substring("term", 2, 1), F.lit("*")).alias("pattern")), Q.expand_wildcard, **more),
        "fuzzy": Q.fuzzy_scores(ix, one.withColumnRenamed("term", "qterm").withColumn("qtf", F.lit(2)), **more),
        "mixed": Q.mixed_scores(ix, _mixed(spark), **more),
        "grouped": C.grouped_scores(ix, _nodes(spark), **more),
    }


def _plain(spark, ix):
    terms = _terms(spark)
    pairs = Q.phrase_terms(spark.createDataFrame([(1, "aa ab ba"), (2, "ab abc")], "query_id int, text string"))
    return {"tfidf": Q.tfidf_scores(ix, terms), "bm25": Q.bm25_scores(ix, terms, require_all=False), "phrase": Q.phrase_scores(ix, pairs),
            "bounded": bounded.BoundedSearch(ix, bounded.posting_blocks(ix.postings, ix.term_stats), terms).hits(),
            "near": C.near_matches(ix, pairs.select("query_id", "phrase_id", "field", "term"), 3).withColumn("score", F.col("freq").cast("double"))}


def _rows(df) -> dict:
    return {(r["query_id"], r["doc_id"]): r["score"] for r in df.select("query_id", "doc_id", "score").collect()}


@pytest.fixture(scope="module")
def expected(spark, indexes):
    return {name: _rows(df) for name, df in _searches(spark, indexes[0]).items()}


def _same(rows: dict, want: dict, name: str) -> None:
    assert want and rows.keys() == want.keys(), name
    assert all(rows[k] == pytest.approx(want[k], rel=1e-9, abs=1e-12) for k in want), name


def test_same_scores(spark, indexes, expected):
    for name, df in _searches(spark, indexes[1]).items():
        _same(_rows(df), expected[name], name)


def test_other_searches_over_parts(spark, indexes):
    loose, lying = (_plain(spark, ix) for ix in indexes)
    for name in loose:
        _same(_rows(lying[name]), _rows(loose[name]), name)


def test_the_best_are_the_same(spark, indexes, expected):
    """Pruned in the tasks: ranks, scores and ties are those of all scores."""
    for name, found in _searches(spark, indexes[1], best=4).items():
        scores = spark.createDataFrame([(*k, s) for k, s in expected[name].items()], "query_id int, doc_id string, score double")
        rows = [sorted(Q.rank_hits(df, 1, 4).select("query_id", "rank", F.coalesce("doc_id", F.lit("")).alias("doc_id"), "score").collect()) for df in (scores, found)]
        assert rows[0] == rows[1], name


def test_postings_stay_where_they_lie(spark, indexes):
    """The postings reach the tasks from their table without an exchange; the lists of clauses come to them by part."""
    one = _terms(spark).select("query_id", F.col("term").alias("clause_id"), "field", F.substring("term", 1, 1).alias("prefix"))
    plan = Q.prefix_scores(indexes[1], one, best=4)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "FlatMapCoGroupsInArrow" in line)
    scan = next(i for i, line in enumerate(plan) if i > at and "Scan parquet" in line)
    assert not [line for line in plan[at:scan] if "Exchange" in line]
    assert [line for line in plan[scan:] if "Exchange hashpartitioning(part" in line]


def test_kinds_that_nobody_asks_are_not_looked_up(spark, indexes, monkeypatch):
    def refused(*args, **more):
        raise AssertionError("looked up")

    for name in ("expand_wildcard", "expand_range", "expand_fuzzy", "phrase_matches"):
        monkeypatch.setattr(Q, name, refused)
    clauses = spark.createDataFrame([(1, 1, Q.TERM, "sectionText", "aa", None, Q.SHOULD, 1.0), (1, 2, Q.PREFIX, "sectionText", "b", None, Q.SHOULD, 1.0)], CLAUSES)
    assert Q.mixed_scores(indexes[1], clauses, best=3).count() >= 3


@pytest.mark.parametrize("written", [False, True])
def test_grams_are_not_shuffled(spark, written):
    """Grams meet the asked ones where they are read or made; what travels has a pattern or is counted."""
    stats = spark.createDataFrame([("f", "abc", 1), ("f", "xbcy", 2)], "field string, term string, df long")
    asked = spark.createDataFrame([("f", "*bc*")], "field string, pattern string")
    found = D.matching_terms(stats, asked, D.term_grams(stats) if written else None)
    assert sorted(r["term"] for r in found.collect()) == ["abc", "xbcy"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") >= 2


def test_candidates_that_rounding_can_lift():
    """A score that only rounding lifts to the k-th best stays; of equal scores no more than k do."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        n, k = int(rng.integers(1, 60)), int(rng.integers(1, 6))
        col, doc = rng.integers(0, 3, n), np.arange(n)
        score = rng.integers(0, 4, n) / 7 + rng.integers(0, 4, n) * 4e-7
        keep = set(matching._best(col, doc, score, k).tolist())
        for c in range(3):
            order = sorted(np.flatnonzero(col == c), key=lambda i: (-round(score[i], 6), doc[i]))
            assert set(order[:k]) <= keep
