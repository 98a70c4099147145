"""Searches over postings that lie dealt by document: the same hits as over loose ones, and no posting or match is shuffled."""

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

from wikipassages.operators import clauses as C
from wikipassages.operators import index as I
from wikipassages.operators import search as Q
from wikipassages.session import materialize


@pytest.fixture(scope="module")
def indexes(spark):
    words = ["ab", "abc", "abd", "acd", "bcd", "xyz", "xy", "zz"]
    rows = [(f"k{i}", f"p{i}", "s", 1, " ".join(words[(i * 3 + j * (i % 5 + 1)) % len(words)] for j in range(3 + i % 7))) for i in range(60)]
    loose = I.build_index(spark.createDataFrame(rows, "key string, page string, section string, n int, text string"))
    postings = materialize(spark, "test-by-document", lambda: loose.postings, bucket="doc_id")
    stats = materialize(spark, "test-by-document-stats", lambda: I.term_frequencies(postings))
    docs = materialize(spark, "test-by-document-docs", lambda: loose.docs)
    lengths = materialize(spark, "test-by-document-lengths", lambda: I.field_lengths(postings))
    return loose, dataclasses.replace(loose, docs=docs, postings=postings, term_stats=stats, field_len=lengths, by_document=True)


def _searches(spark, ix):
    queries = spark.createDataFrame([(1, "ab abc xyz"), (2, "xy zz bcd"), (3, "abc ab")], "query_id int, text string")
    terms = Q.query_terms(queries)
    one = terms.select("query_id", F.col("term").alias("clause_id"), "field", "term")
    phrases = Q.phrase_terms(queries)
    return {
        "tfidf": Q.tfidf_scores(ix, terms), "bm25": Q.bm25_scores(ix, terms),
        "prefix": Q.prefix_scores(ix, one.withColumn("prefix", F.substring("term", 1, 2))),
        "wildcard": Q.shared_clause_scores(ix, one.select("query_id", "clause_id", "field", F.concat(F.substring("term", 1, 1), F.lit("*")).alias("pattern")), Q.expand_wildcard),
        "fuzzy": Q.fuzzy_scores(ix, one.withColumnRenamed("term", "qterm")),
        "phrase": Q.phrase_scores(ix, phrases),
        "near": C.near_matches(ix, phrases.select("query_id", "phrase_id", "field", "term"), 3)
        .select("query_id", F.concat_ws("/", "phrase_id", "doc_id").alias("doc_id"), F.col("freq").cast("double").alias("score")),
    }


def test_same_hits_and_no_shuffled_matches(spark, indexes):
    loose, bucketed = (_searches(spark, ix) for ix in indexes)
    for name, found in bucketed.items():
        rows = [{(r["query_id"], r["doc_id"]): r["score"] for r in df.collect()} for df in (loose[name], found)]
        assert rows[0] and rows[0].keys() == rows[1].keys(), name
        assert all(rows[0][k] == pytest.approx(rows[1][k], rel=1e-9) for k in rows[0]), name
        plan = found._jdf.queryExecution().executedPlan().toString()
        exchanged = [keys for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "doc_id" in keys]
        assert not exchanged, (name, exchanged)


def test_what_queries_ask_alike_is_met_once(spark, indexes):
    """Two queries of one clause have the list of its terms once; a clause asked twice by one query counts twice."""
    clauses = spark.createDataFrame([(1, "a", "sectionText", "ab"), (2, "a", "sectionText", "ab"), (2, "b", "sectionText", "ab")],
                                    "query_id int, clause_id string, field string, prefix string")
    rows = Q.prefix_scores(indexes[1], clauses).collect()
    assert {r["score"] for r in rows if r["query_id"] == 1} == {1.0}
    assert {round(r["score"], 6) for r in rows if r["query_id"] == 2} == {round(4 / 2 ** 1.5, 6)}
