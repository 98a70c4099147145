"""Answers that depend on documents being kept apart, on fields and on clause kinds."""

import pytest
from pyspark.sql import functions as F

from wikipassages.operators import index as I
from wikipassages.operators import search as Q
from wikipassages.plans import catalog, prototype, staged
from wikipassages.plans.corpus import corpus_xml
from wikipassages.plans.primary import run_primary_records
from wikipassages.sources import lines

from conftest import SMALL

SECTIONS = [("p#a", "p", "a", 3, "the cat sat on the mat"), ("p#b", "p", "b", 1, "a dog and a cat"), ("r#e", "r", "e", 5, "mat of straw")]
SCHEMA = "key string, page string, section string, n int, text string"


def _found(scores) -> set:
    return {r["doc_id"] for r in scores.collect()}


@pytest.fixture
def queries(spark):
    return spark.createDataFrame([(1, "cat mat")], "query_id int, text string")


def test_search_after_an_append(spark, tmp_path, queries):
    secs = spark.createDataFrame(SECTIONS, SCHEMA)
    I.write_index(I.build_index(secs), str(tmp_path), mode="overwrite")
    I.write_index(I.build_index(secs, load="second"), str(tmp_path), mode="append")
    ix = I.read_index(spark, str(tmp_path))
    both = {"p#a", f"p#a{I.ID_SEP}second"}
    assert _found(Q.bm25_scores(ix, Q.query_terms(queries))) == both
    assert _found(Q.tfidf_scores(ix, Q.query_terms(queries, occur=Q.MUST))) == both
    phrase = Q.phrase_terms(spark.createDataFrame([(1, "cat sat")], "query_id int, text string"))
    assert {(r["doc_id"], r["freq"]) for r in Q.phrase_matches(ix, phrase).collect()} == {(d, 1) for d in both}
    assert {r["key"] for r in ix.docs.collect()} == {s[0] for s in SECTIONS} and ix.docs.count() == 6


def test_two_sources_share_keys(spark, queries):
    secs = spark.createDataFrame([(*s, source) for s in SECTIONS for source in ("en", "sk")], SCHEMA + ", source string") \
        .withColumn("text", F.when(F.col("source") == "sk", F.regexp_replace("text", "mat", "rug")).otherwise(F.col("text")))
    red = spark.createDataFrame([("p#a", "Cat Page", "en"), ("p#a", "Other", "sk")], "key string, redirect string, source string")
    ix = I.build_index(secs, red, source="source")
    assert ix.docs.count() == 6
    assert _found(Q.bm25_scores(ix, Q.query_terms(queries))) == {f"p#a{I.ID_SEP}en"}
    titles = Q.query_terms(spark.createDataFrame([(1, "other")], "query_id int, text string"), field=I.REDIRS_FIELD)
    assert _found(Q.tfidf_scores(ix, titles)) == {f"p#a{I.ID_SEP}sk"}


def test_stored_char_count(spark):
    docs = I.build_index(spark.createDataFrame(SECTIONS, SCHEMA)).docs
    assert {r["doc_id"]: r["char_count"] for r in docs.collect()} == {s[0]: len(s[4]) for s in SECTIONS}


def test_phrases_inside_one_redirect_title(spark, tmp_path):
    red = spark.createDataFrame([("p#a", "Big Cat Page"), ("p#a", "Cat Page"), ("p#a", "Cat"), ("p#b", "Page Cat")], "key string, redirect string")
    built = I.build_index(spark.createDataFrame(SECTIONS, SCHEMA), red)
    I.write_index(built, str(tmp_path / "ix"), mode="overwrite")
    q = spark.createDataFrame([(1, "cat page")], "query_id int, text string")
    for ix in (built, I.read_index(spark, str(tmp_path / "ix"))):
        found = Q.phrase_matches(ix, Q.phrase_terms(q, field=I.REDIRS_FIELD)).collect()
        assert [(r["doc_id"], r["freq"]) for r in found] == [("p#a", 2)]


def test_linking_titles_are_not_stemmed(spark):
    pages = spark.createDataFrame([("Target", "some running text", "wikitext", None), ("Running Cats", "#REDIRECT [[Target]]", "wikitext", "Target")],
                                  "title string, text string, model string, redirect string")
    ix = prototype.prototype_index(pages)
    terms = {(r["field"], r["term"]) for r in ix.postings.select("field", "term").collect()}
    assert {t for f, t in terms if f == "r_from"} == {"running", "cats"}
    assert ("text", "run") in terms and ("text", "running") not in terms


def test_section_line_without_a_page_is_a_dead_letter(spark):
    sep = "█" * 3
    rows = spark.createDataFrame([(f"p#s\tp{sep}s{sep}1{sep}R{sep}text",), (f"nokey{sep}s{sep}1{sep}R{sep}text",)], "value string")
    out = lines.parse_section_lines(rows).collect()
    assert [(r["key"], r["page"], r["is_malformed"]) for r in out] == [("p#s", "p", False), ("nokey", None, True)]


def test_self_redirect_does_not_lose_its_group(spark):
    secs = spark.createDataFrame([("P#S", "P#S", "#REDIRECT [[P#S]] "), ("R", "R", "#REDIRECT [[P#S]] "), ("Q#T", "Q#T", "#REDIRECT [[Q#T]] ")],
                                 "key string, title string, text string")
    assert {r["key"] for r in staged.redirected_texts(secs).collect()} == {"P#S"}
    assert {r["key"] for r in staged.redirected_groups(staged.redirect_groups(secs)).collect()} == {"P#S"}


def test_mixed_clauses(spark):
    ix = I.build_index(spark.createDataFrame(SECTIONS, SCHEMA))
    rows = [(1, 0, Q.PHRASE, "sectionText", "cat sat", None, Q.SHOULD, 1.0), (1, 1, Q.TERM, "sectionText", "mat", None, Q.SHOULD, 2.0),
            (1, 2, Q.TERM, "pageTitle", "r", None, Q.MUST_NOT, 1.0), (2, 0, Q.PREFIX, "sectionText", "str", None, Q.MUST, 1.0),
            (2, 1, Q.WILDCARD, "sectionText", "m?t", None, Q.SHOULD, 1.0), (3, 0, Q.FUZZY, "sectionText", "dug", None, Q.SHOULD, 1.0),
            (4, 0, Q.RANGE, "sectionText", "cat", "dog", Q.SHOULD, 1.0), (5, 0, Q.PREFIX, "sectionText", "none", None, Q.SHOULD, 1.0)]
    clauses = spark.createDataFrame(rows, "query_id int, clause_id int, kind string, field string, value string, value2 string, occur string, boost double")
    out = {}
    for r in Q.mixed_scores(ix, clauses).collect():
        out.setdefault(r["query_id"], {})[r["doc_id"]] = r["score"]
    assert set(out[1]) == {"p#a"} and set(out[2]) == {"r#e"} and set(out[3]) == {"p#b"} and set(out[4]) == {"p#a", "p#b"} and 5 not in out
    # two constant clauses, both met: 2 / sqrt(2) * 2 / 2
    assert out[2]["r#e"] == pytest.approx(2 ** 0.5)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_build_plans_have_no_cross_joins_or_python(spark):
    res = run_primary_records(corpus_xml(spark, SMALL))
    pages = catalog.parsed_pages(spark, SMALL)
    ix = I.build_index(res.redirected, res.redirects.select("key", "redirect"))
    proto = prototype.prototype_index(pages)
    sections = staged.merged_sections(staged.page_records(catalog.staged_pages(spark, SMALL)))
    for df in (res.redirected, res.redirects, res.sections, ix.docs, ix.postings, ix.field_len, ix.term_stats, proto.postings, sections,
               staged.redirected_texts(sections)):
        plan = _plan(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInArrow"):
            assert bad not in plan
