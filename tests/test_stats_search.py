"""Statistics and search on small hand-made sections, against plain-Python arithmetic."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wikipassages.functions.analysis import STOP_WORDS
from wikipassages.operators import index as I
from wikipassages.operators import search as Q
from wikipassages.operators import stats

SECTIONS = [
    ("p#a", "p", "a", 3, "the cat sat on the mat"),
    ("p#b", "p", "b", 1, "a dog and a cat"),
    ("q#c", "q", "c", 2, "dogs run; cats sleep. The cat naps"),
    ("q#d", "q", "d", 1, ""),
    ("r#e", "r", "e", 5, "mat of straw"),
]


@pytest.fixture(scope="module")
def secs(spark):
    return spark.createDataFrame(SECTIONS, "key string, page string, section string, n int, text string")


@pytest.fixture(scope="module")
def ix(spark, secs):
    red = spark.createDataFrame([("p#a", "Cat Page"), ("p#a", "Mat"), ("q#c", "Cats")], "key string, redirect string")
    return I.build_index(secs, red)


def toks(text):
    import re
    return [t.lower() for t in re.findall(r"[^\W\d_]+", text) if t.lower() not in STOP_WORDS]


def test_section_stats(secs):
    row = stats.section_stats(secs).first()
    assert row["sections"] == 4 and row["zero_char"] == 0
    assert row["longest_section"] == "c" and row["most_redirs"] == 5 and row["most_redirs_page"] == "r"
    assert row["avg_redirs"] == pytest.approx((3 + 1 + 2 + 5) / 4)


def test_histograms(spark, secs):
    h = {r["redirs_count"]: r["freq"] for r in stats.redirs_count_histogram(secs).collect()}
    assert h == {3: 1, 1: 1, 2: 1, 5: 1}
    w = stats.weighted_histogram(stats.redirs_count_histogram(secs), 2).collect()
    assert sorted((r["bin"], r["n_values"]) for r in w) == [(1, 2), (2, 2)]


def test_tfidf_against_python(spark, ix):
    queries = spark.createDataFrame([(1, "cat mat"), (2, "dog")], "query_id int, text string")
    got = {(r["query_id"], r["doc_id"]): r["score"] for r in
           Q.tfidf_scores(ix, Q.query_terms(queries)).collect()}
    docs = {k: toks(t) for k, _, _, _, t in SECTIONS if t}
    n = len(docs)
    for qid, qtext in [(1, "cat mat"), (2, "dog")]:
        qt = toks(qtext)
        idf = {t: 1 + math.log(n / (sum(t in d for d in docs.values()) + 1)) for t in qt}
        norm = 1 / math.sqrt(sum(idf[t] ** 2 for t in qt))
        for k, d in docs.items():
            hit = [t for t in qt if t in d]
            if not hit:
                assert (qid, k) not in got
                continue
            raw = sum(math.sqrt(d.count(t)) * idf[t] ** 2 / math.sqrt(len(d)) for t in hit)
            assert got[(qid, k)] == pytest.approx(raw * norm * len(hit) / len(qt))


def test_boolean_occur(spark, ix):
    q = spark.createDataFrame([(1, "sectionText", "cat", 1, 1.0, "must"), (1, "sectionText", "mat", 1, 1.0, "should"),
                               (1, "sectionText", "sat", 1, 1.0, "must_not")],
                              "query_id int, field string, term string, qtf int, boost double, occur string")
    assert sorted(r["doc_id"] for r in Q.tfidf_scores(ix, q).collect()) == ["p#b", "q#c"]


def test_bm25_requires_all_terms(spark, ix):
    queries = spark.createDataFrame([(1, "cat mat")], "query_id int, text string")
    rows = Q.bm25_scores(ix, Q.query_terms(queries)).collect()
    assert [r["doc_id"] for r in rows] == ["p#a"]


def test_phrase_with_stop_word_gap(spark, ix):
    queries = spark.createDataFrame([(1, "cat sat on the mat"), (2, "mat cat")], "query_id int, text string")
    rows = sorted((r["query_id"], r["phrase_id"], r["doc_id"], r["freq"]) for r in
                  Q.phrase_matches(ix, Q.phrase_terms(queries)).collect())
    # "sat mat" holds a two-token gap ("on the"); "mat cat" occurs nowhere
    assert rows == [(1, 1, "p#a", 1), (1, 2, "p#a", 1)]


def test_prefix_expansion(spark, ix):
    pre = spark.createDataFrame([(1, "c", "sectionText", "cat")], "query_id int, clause_id string, field string, prefix string")
    terms = sorted(r["term"] for r in Q.expand_prefix(ix, pre).collect())
    assert terms == ["cat", "cats"]


def test_fuzzy_expansion_matches_brute_force(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    text = " ".join(words)
    secs = spark.createDataFrame([("k#s", "k", "s", 1, text)], "key string, page string, section string, n int, text string")
    ix = I.build_index(secs)
    vocab = set(toks(text))
    qs = words[:40]
    fz = spark.createDataFrame([(i, w, "sectionText", w) for i, w in enumerate(qs)],
                               "query_id int, clause_id string, field string, qterm string")
    got = {(r["qterm"], r["term"]) for r in Q.expand_fuzzy(ix, fz).collect()}

    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]
    want = {(q, t) for q in qs for t in vocab if lev(q, t) <= 2}
    assert got == want


def test_ranking_pages_and_display(spark, ix):
    queries = spark.createDataFrame([(1, "cat")], "query_id int, text string")
    scores = Q.tfidf_scores(ix, Q.query_terms(queries))
    first = Q.rank_hits(scores, 1, 2).collect()
    second = Q.page_of_hits(scores, 2).collect()
    assert [r["rank"] for r in first] == [1, 2] and second == []
    red = spark.createDataFrame([("p#a", "Cat Page"), ("p#a", "Mat")], "key string, redirect string")
    hits = Q.hits_with_fields(ix, Q.rank_hits(scores), red, "default").orderBy("rank").collect()
    assert hits[0]["hit"].startswith("1. ") and hits[0]["hit"].endswith("█")
    with pytest.warns(UserWarning, match="nope"):
        assert Q.resolve_display(["pageTitle", "nope", "pageTitle"]) == ["pageTitle"]


def test_redirs_from_field_is_indexed(spark, ix):
    q = spark.createDataFrame([(1, "redirsFrom", "page", 1, 1.0, "should")],
                              "query_id int, field string, term string, qtf int, boost double, occur string")
    assert [r["doc_id"] for r in Q.tfidf_scores(ix, q).collect()] == ["p#a"]


def test_stemmed_index(spark, secs):
    ix = I.build_index(secs, stem=True)
    terms = {r["term"] for r in ix.term_stats.where(F.col("field") == "sectionText").collect()}
    assert "cat" in terms and "cats" not in terms and "dog" in terms and "nap" in terms


def test_wildcard_and_range_expansion(spark, ix):
    pats = spark.createDataFrame([(1, "w1", "sectionText", "c?t*"), (1, "w2", "sectionText", "*og"),
                                  (1, "w3", "sectionText", "m_t")],
                                 "query_id int, clause_id string, field string, pattern string")
    got = sorted((r["clause_id"], r["term"]) for r in Q.expand_wildcard(ix, pats).collect())
    assert got == [("w1", "cat"), ("w1", "cats"), ("w2", "dog")]   # "_" is literal, not a wildcard
    rng = spark.createDataFrame([(1, "r1", "sectionText", "cat", "dogs"), (1, "r2", "sectionText", "s", "sz")],
                                "query_id int, clause_id string, field string, lo string, hi string")
    got = sorted((r["clause_id"], r["term"]) for r in Q.expand_range(ix, rng).collect())
    assert got == [("r1", "cat"), ("r1", "cats"), ("r1", "dog"), ("r1", "dogs"),
                   ("r2", "sat"), ("r2", "sleep"), ("r2", "straw")]


def test_index_write_append_and_overwrite(spark, secs, tmp_path):
    path = str(tmp_path / "ix")
    built = I.build_index(secs)
    I.write_index(built, path, mode="overwrite")
    once = I.read_index(spark, path)
    assert once.docs.count() == 4
    cat_once = once.term_stats.where("field = 'sectionText' AND term = 'cat'").first()["df"]
    I.write_index(built, path, mode="append")      # re-indexing the same input doubles it
    twice = I.read_index(spark, path)
    assert twice.docs.count() == 8
    assert twice.term_stats.where("field = 'sectionText' AND term = 'cat'").first()["df"] == 2 * cat_once
