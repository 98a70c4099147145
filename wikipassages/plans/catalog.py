"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables (the wiki corpus is derived from all of
``documents``), so its work grows with them. Column names match the SQL twins
in ``oracle_sql.py``.
"""

from __future__ import annotations

import dataclasses

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import porter
from ..functions.analysis import analyze, analyze_words
from ..functions.text import normalize_title
from ..operators import bounded, clauses as trees, dictionary, index, links, matching, search, segments, stats
from ..operators.redirects import join_redirected_sections
from ..operators.sections import explode_redirect_targets
from ..session import buckets, materialize, stage_path
from ..sources import dump, groups, lines
from . import corpus, prototype, staged
from .primary import PrimaryResult, run_primary_records


def primary(spark: SparkSession, sf_dir: str) -> PrimaryResult:
    """The primary job on the derived corpus, written once per application and sf."""
    def run() -> PrimaryResult:
        return run_primary_records(corpus.corpus_xml(spark, sf_dir))
    redirects = materialize(spark, f"redirects:{sf_dir}", lambda: run().redirects)
    # The join reads the written redirect table, so the redirect branch runs once.
    redirected = materialize(spark, f"redirected:{sf_dir}",
                             lambda: join_redirected_sections(redirects, run().sections), bucket="key")
    return PrimaryResult(redirects, run().sections, redirected)


def redirected_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: each section some redirect points at, with its text and redirect count."""
    return primary(spark, sf_dir).redirected


def section_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index's sanity statistics in one row."""
    return stats.section_stats(redirected_sections(spark, sf_dir))


def redirs_count_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency of each redirect count."""
    return stats.redirs_count_histogram(redirected_sections(spark, sf_dir))


def redirs_hist_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-weighted histogram of redirect counts, 30 bins."""
    return stats.weighted_histogram(redirs_count_hist(spark, sf_dir), 30)


def redirs_hist_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-weighted histogram of redirect counts, 100 bins."""
    return stats.weighted_histogram(redirs_count_hist(spark, sf_dir), 100)


def _with_source(sections: DataFrame) -> DataFrame:
    # one dump per language, as the reference indexes an "en" and an "sk"
    # output and reports each apart: the source is the page's language
    return sections.withColumn("source", F.substring_index("page", "–", -1))


#: Folder of the section lines of all pages without a language (no language holds the sign).
NO_LANGUAGE = "–"


def section_line_files(redirected: DataFrame, redirects: DataFrame, path: str) -> DataFrame:
    """K3 + S9: section lines written apart for each language, and read back with their ``source``.

    The lines of pages without a language, which are sources of their own, share one folder: a folder
    for each would be as many as there are such pages."""
    folder = F.when(F.instr("page", "–") > 0, F.col("source")).otherwise(NO_LANGUAGE)
    rows = lines.sections_with_redirs(_with_source(redirected), redirects).withColumn("source", folder)
    lines.write_lines(rows, lines.section_line(), path, partition_by="source")
    read = lines.parse_section_lines(lines.read_lines(redirected.sparkSession, f"{path}/*", with_file=True))
    named = F.regexp_extract("source_file", r"/source=([^/]*)/", 1)
    return _with_source(read.where(~F.col("is_malformed"))).select(
        "key", "page", "section", "n", "text", F.when(F.try_url_decode(named) == NO_LANGUAGE, F.col("source")).otherwise(named).alias("source"))


def section_stats_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the statistics of A5-A7 reported apart per source (language)."""
    return stats.section_stats(_with_source(redirected_sections(spark, sf_dir)), by=["source"])


def redirs_count_hist_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + K5: redirect-count frequencies per source (one count file per input)."""
    return stats.redirs_count_histogram(_with_source(redirected_sections(spark, sf_dir)), by=["source"])


def section_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of the redirect side: one row per redirect to a section."""
    return primary(spark, sf_dir).redirects


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word frequencies over all document texts."""
    return stats.word_count(corpus.read_table(spark, sf_dir, "documents"))


def section_index(spark: SparkSession, sf_dir: str, stem: bool = False) -> index.SearchIndex:
    """Q2: the search index over the redirected sections, written once per application and sf."""
    res = primary(spark, sf_dir)

    tag = f"{sf_dir}:{'stem' if stem else 'plain'}"
    # the documents are the written sections: no copy of them is written, and their texts are not dealt out again
    ix = index.build_index(res.redirected, res.redirects.select("key", "redirect"), stem=stem, by_key=True)
    # a part is a bucket of documents: its postings are written where they were made
    n = buckets(spark)
    part = matching.part_of(spark, n)
    postings = materialize(spark, f"index-postings:{tag}:{n}", lambda: ix.postings.withColumn("part", part), bucket="part")
    # statistics from the written postings instead of a second tokenisation
    parts = materialize(spark, f"index-parts:{tag}:{n}", lambda: index.part_terms(postings))
    term_stats = materialize(spark, f"index-term_stats:{tag}", lambda: parts.groupBy("field", "term").agg(F.sum("n").alias("df")))
    return index.SearchIndex(ix.docs, postings, term_stats, index.field_lengths(postings), by_document=True, parts=parts, part_of=part)


def gram_index(spark: SparkSession, sf_dir: str) -> index.SearchIndex:
    """Q7: the same index with its gram postings written, too, each file sorted by gram; they are not shuffled for it."""
    ix = section_index(spark, sf_dir)
    grams = materialize(spark, f"index-grams:{sf_dir}", lambda: dictionary.term_grams(ix.term_stats).sortWithinPartitions("field", "gram"))
    return dataclasses.replace(ix, grams=grams)


def block_index(spark: SparkSession, sf_dir: str) -> index.SearchIndex:
    """Q7: the same index with its sorted dictionary written in blocks, too."""
    ix = section_index(spark, sf_dir)
    return dataclasses.replace(ix, blocks=materialize(spark, f"index-blocks-of-terms:{sf_dir}", lambda: dictionary.term_blocks(ix.term_stats)))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query texts: every ``benchmark`` item is one query."""
    return corpus.read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _top(scores: DataFrame, first: int = 1, last: int = search.HITS_PER_PAGE) -> DataFrame:
    return search.rank_hits(scores, first, last).select("query_id", "rank", "doc_id", "score")


def search_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + Q8: top 10 sections per benchmark text, TF-IDF, OR of all terms."""
    ix = section_index(spark, sf_dir)
    return _top(search.tfidf_scores(ix, search.query_terms(benchmark_queries(spark, sf_dir))))


def search_tfidf_page2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the second page (ranks 11-20) of the same searches."""
    ix = section_index(spark, sf_dir)
    return _top(search.tfidf_scores(ix, search.query_terms(benchmark_queries(spark, sf_dir))), 11, 20)


def search_next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: what follows the first page of ``search_tfidf``, from where that page ends, with the hits on it and whether there are more."""
    return search.next_page(search.tfidf_scores(section_index(spark, sf_dir), search.query_terms(benchmark_queries(spark, sf_dir))))


def bounded_search(spark: SparkSession, sf_dir: str) -> bounded.BoundedSearch:
    """The bounded search of all terms of every benchmark text, over the index's posting blocks."""
    ix = section_index(spark, sf_dir)
    blocks = materialize(spark, f"index-blocks:{sf_dir}", lambda: bounded.posting_blocks(ix.postings, ix.term_stats))
    return bounded.BoundedSearch(ix, blocks, search.query_terms(benchmark_queries(spark, sf_dir)))


def search_tfidf_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + Q8: the searches of ``search_tfidf`` in two passes, the second over the blocks that can still matter."""
    return bounded_search(spark, sf_dir).hits().select("query_id", "rank", "doc_id", "score")


def search_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: terms repeated in a benchmark text are required (must), the others optional; top 10."""
    ix = section_index(spark, sf_dir)
    q = search.query_terms(benchmark_queries(spark, sf_dir))
    q = q.withColumn("occur", F.when(F.col("qtf") >= 2, F.lit(search.MUST)).otherwise(F.lit(search.SHOULD)))
    return _top(search.tfidf_scores(ix, q))


def search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: top 10 per benchmark text, BM25, all terms required."""
    ix = section_index(spark, sf_dir)
    return _top(search.bm25_scores(ix, search.query_terms(benchmark_queries(spark, sf_dir))))


def search_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: occurrences of every neighbouring-term phrase of every benchmark text."""
    ix = section_index(spark, sf_dir)
    return search.phrase_matches(ix, search.phrase_terms(benchmark_queries(spark, sf_dir)))


def search_phrase_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: top 10 sections for the neighbouring-term phrases of every benchmark text."""
    ix = section_index(spark, sf_dir)
    return _top(search.phrase_scores(ix, search.phrase_terms(benchmark_queries(spark, sf_dir))))


def search_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: ``term*`` for every term of every benchmark text, constant-score clauses, top 10."""
    ix = section_index(spark, sf_dir)
    q = (search.query_terms(benchmark_queries(spark, sf_dir))
         .select("query_id", F.col("term").alias("clause_id"), "field", F.col("term").alias("prefix")))
    return _top(search.prefix_scores(ix, q, best=search.HITS_PER_PAGE))


def search_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: ``term~2`` for every term of every benchmark text (nested fuzzy clauses, TF-IDF), top 10."""
    ix = section_index(spark, sf_dir)
    q = (search.query_terms(benchmark_queries(spark, sf_dir))
         .select("query_id", F.col("term").alias("clause_id"), "field", F.col("term").alias("qterm"), "qtf"))
    return _top(search.fuzzy_scores(ix, q, best=search.HITS_PER_PAGE))


def staged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 over the corpus records: one row per revision, no filter."""
    return dump.parse_page_revisions(corpus.corpus_xml(spark, sf_dir))


def staged_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs 1-2 of the staged chain: merged level-2 sections ``key, text``."""
    return staged.merged_sections(staged.page_records(staged_pages(spark, sf_dir))).select("key", "text")


def staged_redirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs 1-4: ``key, text`` of sections some record redirects to (L5 rows)."""
    secs = materialize(spark, f"staged-sections:{sf_dir}", lambda: staged.merged_sections(
        staged.page_records(staged_pages(spark, sf_dir))))
    return staged.redirected_texts(secs)


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus's pages, parsed once and written."""
    return materialize(spark, f"pages:{sf_dir}", lambda: dump.parse_pages(corpus.corpus_xml(spark, sf_dir)))


def link_inversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``title, r_from`` - pages that redirect to or main-link each page."""
    return links.inverted_links(parsed_pages(spark, sf_dir))


def prototype_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11-Q13: the prototype's stemmed BM25 search (all terms) over link-inverted pages."""
    pages = parsed_pages(spark, sf_dir)
    docs = materialize(spark, f"proto-docs:{sf_dir}", lambda: prototype.prototype_docs(pages))
    inverted = materialize(spark, f"proto-inverted:{sf_dir}", lambda: links.inverted_links(pages))
    postings = materialize(spark, f"proto-postings:{sf_dir}", lambda: prototype.prototype_index(
        pages, docs=docs, inverted=inverted).postings, bucket="doc_id")
    term_stats = materialize(spark, f"proto-term_stats:{sf_dir}", lambda: index.term_frequencies(postings))
    field_len = materialize(spark, f"proto-field_len:{sf_dir}", lambda: index.field_lengths(postings))
    ix = index.SearchIndex(docs, postings, term_stats, field_len, by_document=True)
    return prototype.prototype_search(ix, benchmark_queries(spark, sf_dir))


def stem_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: the stem of every term of all document texts."""
    docs = corpus.read_table(spark, sf_dir, "documents")
    terms = docs.select(F.explode(analyze_words(F.col("text"))).alias("t")).select(F.col("t.term").alias("term")).distinct()
    return terms.select("term", porter.stem(F.col("term")).alias("stem"))


def normalized_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised title of every marked-up one."""
    return corpus.raw_titles(spark, sf_dir).select("doc_id", "i", normalize_title(F.col("raw")).alias("title"))


def markup_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 (all levels), T3, C4, A1, F6, S1 (first revision): the primary job over the markup corpus."""
    return run_primary_records(corpus.markup_xml(spark, sf_dir)).redirected


# ---------------------------------------------------------------- more clause kinds
def search_must_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: the alphabetically first term of each benchmark text is forbidden, the others optional; top 10."""
    q = search.query_terms(benchmark_queries(spark, sf_dir))
    first = q.groupBy("query_id").agg(F.min("term").alias("first"))
    q = q.join(first, "query_id").withColumn(
        "occur", F.when(F.col("term") == F.col("first"), F.lit(search.MUST_NOT)).otherwise(F.lit(search.SHOULD))).drop("first")
    return _top(search.tfidf_scores(section_index(spark, sf_dir), q))


def _constant(spark: SparkSession, sf_dir: str, clauses: DataFrame, expand) -> DataFrame:
    ix = {search.expand_wildcard: gram_index, search.expand_range: block_index}[expand](spark, sf_dir)
    return _top(search.shared_clause_scores(ix, clauses, expand, best=search.HITS_PER_PAGE))


def _term_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (search.query_terms(benchmark_queries(spark, sf_dir))
            .select("query_id", F.col("term").alias("clause_id"), "field", "term"))


def search_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: first two letters, any run, any letter, the last letter - for every term of three letters or more."""
    q = _term_clauses(spark, sf_dir).where(F.length("term") >= 3)
    pattern = F.concat(F.substring("term", 1, 2), F.lit("*?"), F.expr("right(term, 1)"))
    return _constant(spark, sf_dir, q.withColumn("pattern", pattern).drop("term"), search.expand_wildcard)


def search_infix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: for every term of four letters or more two patterns that do not start with a letter:
    its 2nd to 4th letter anywhere (``*bcd*``), and its 2nd and 3rd after any one (``?bc*``)."""
    q = _term_clauses(spark, sf_dir).where(F.length("term") >= 4)
    inside = F.array(F.concat(F.lit("*"), F.substring("term", 2, 3), F.lit("*")), F.concat(F.lit("?"), F.substring("term", 2, 2), F.lit("*")))
    clauses = q.select("query_id", "field", F.explode(inside).alias("pattern")).distinct() \
        .select("query_id", F.col("pattern").alias("clause_id"), "field", "pattern")
    return _constant(spark, sf_dir, clauses, search.expand_wildcard)


def search_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: all terms from a query's term up to the term followed by ``m``."""
    q = _term_clauses(spark, sf_dir).select("query_id", "clause_id", "field", F.col("term").alias("lo"),
                                            F.concat("term", F.lit("m")).alias("hi"))
    return _constant(spark, sf_dir, q, search.expand_range)


def mixed_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clause table of all kinds from the alphabetically numbered terms of each benchmark text:
    1 a required prefix, 2 fuzzy, 3 a wildcard of half weight, 4 a range, 5 forbidden, the others
    terms of double weight, and the first two terms as they stand as a phrase."""
    queries = benchmark_queries(spark, sf_dir)
    terms = search.query_terms(queries)
    number = F.row_number().over(Window.partitionBy("query_id").orderBy("term"))
    t = terms.withColumn("i", number)

    def pick(*values):
        """The value for terms 1, 2, 3, 4, 5 and all others."""
        out = values[5]
        for i, v in reversed(list(enumerate(values[:5], 1))):
            out = F.when(F.col("i") == i, v).otherwise(out)
        return out

    term, lit = F.col("term"), F.lit
    clauses = t.select(
        "query_id", F.col("i").alias("clause_id"),
        pick(*map(lit, (search.PREFIX, search.FUZZY, search.WILDCARD, search.RANGE, search.TERM, search.TERM))).alias("kind"), "field",
        pick(F.substring("term", 1, 2), term, F.concat(F.substring("term", 1, 1), lit("*"), F.expr("right(term, 1)")), term, term, term).alias("value"),
        pick(lit(None), lit(None), lit(None), F.concat(term, lit("m")), lit(None), lit(None)).alias("value2"),
        pick(lit(search.MUST), lit(search.SHOULD), lit(search.SHOULD), lit(search.SHOULD), lit(search.MUST_NOT), lit(search.SHOULD)).alias("occur"),
        pick(lit(1.0), lit(1.0), lit(0.5), lit(1.0), lit(1.0), lit(2.0)).alias("boost"))
    tokens = analyze(F.col("text"))
    phrase = queries.where(F.size(tokens) >= 2).select(
        "query_id", lit(0).alias("clause_id"), lit(search.PHRASE).alias("kind"), lit(index.DEFAULT_FIELD).alias("field"),
        F.concat_ws(" ", tokens[0]["term"], tokens[1]["term"]).alias("value"), lit(None).cast("string").alias("value2"),
        lit(search.SHOULD).alias("occur"), lit(1.0).alias("boost"))
    return clauses.unionByName(phrase)


def search_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3-Q8 in one query: clauses of all kinds, required, optional and forbidden, with weights; top 10."""
    ix = block_index(spark, sf_dir)
    return _top(search.mixed_scores(ix, mixed_clauses(spark, sf_dir), best=search.HITS_PER_PAGE))


def grouped_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of clauses from the alphabetically numbered terms of each benchmark text:
    ``+(3 OR 6 OR 9 ... OR (+first three letters of 7* -8)^0.5) (+1 +2)^2 -(+4 +5)``."""
    terms = search.query_terms(benchmark_queries(spark, sf_dir))
    t = terms.withColumn("i", F.row_number().over(Window.partitionBy("query_id").orderBy("term")))
    lit, none, i = F.lit, F.lit(None), F.col("i")

    def by_place(seventh, eighth, third, low, other):
        return F.when(i == 7, seventh).when(i == 8, eighth).when(i % 3 == 0, third).when(i <= 2, low).otherwise(other)

    leaves = t.where("i <= 8 or i % 3 = 0").select(
        "query_id", (i + 10).alias("node_id"), by_place(lit(4), lit(4), lit(1), lit(2), lit(3)).alias("parent_id"),
        F.when(i == 7, search.PREFIX).otherwise(search.TERM).alias("kind"), "field",
        F.when(i == 7, F.substring("term", 1, 3)).otherwise(F.col("term")).alias("value"), none.cast("string").alias("value2"),
        by_place(lit(search.MUST), lit(search.MUST_NOT), lit(search.SHOULD), lit(search.MUST), lit(search.MUST)).alias("occur"), lit(1.0).alias("boost"))
    groups = F.array(*[F.struct(lit(node).alias("node_id"), lit(parent).cast("int").alias("parent_id"), lit(occur).alias("occur"), lit(boost).alias("boost"))
                       for node, parent, occur, boost in ((0, None, search.SHOULD, 1.0), (1, 0, search.MUST, 1.0), (2, 0, search.SHOULD, 2.0),
                                                          (3, 0, search.MUST_NOT, 1.0), (4, 1, search.SHOULD, 0.5))])
    inner = terms.select("query_id").distinct().select("query_id", F.inline(groups)).select(
        "query_id", "node_id", "parent_id", lit(trees.GROUP).alias("kind"), none.cast("string").alias("field"), none.cast("string").alias("value"),
        none.cast("string").alias("value2"), "occur", "boost")
    return leaves.union(inner)


def search_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: queries with groups of clauses inside groups, required, optional and forbidden; top 10."""
    return _top(trees.grouped_scores(section_index(spark, sf_dir), grouped_nodes(spark, sf_dir), best=search.HITS_PER_PAGE))


#: Positions between the first and the last of the terms that ``search_near`` asks for.
NEAR_WIDTH = 6


def search_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: every three neighbouring terms of every benchmark text that differ, in any order within a distance."""
    tokens = analyze(F.col("text"))
    threes = F.filter(F.transform(tokens, lambda s, i: F.when(i >= 2, F.struct(
        (i - 1).alias("phrase_id"), F.array_distinct(F.array(F.element_at(tokens, i - 1)["term"], F.element_at(tokens, i)["term"], s["term"])).alias("terms")))),
        lambda x: F.size(x["terms"]) == 3)
    groups = benchmark_queries(spark, sf_dir).select("query_id", F.inline(threes)) \
        .select("query_id", "phrase_id", F.lit(index.DEFAULT_FIELD).alias("field"), F.explode("terms").alias("term"))
    return trees.near_matches(section_index(spark, sf_dir), groups, NEAR_WIDTH)


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 + Q10 + C16: the shown lines of the TF-IDF hits, default fields."""
    ix = section_index(spark, sf_dir)
    ranked = search.rank_hits(search.tfidf_scores(ix, search.query_terms(benchmark_queries(spark, sf_dir))))
    return search.hits_with_fields(ix, ranked, primary(spark, sf_dir).redirects, "default").select("query_id", "rank", "hit")


def search_after_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + U1: all terms required, BM25, over an index to which the same sections were added again as a second load."""
    def built() -> DataFrame:
        res = primary(spark, sf_dir)
        path = stage_path(spark, "appended-index")
        for mode, load in (("overwrite", None), ("append", "2")):
            index.write_index(index.build_index(res.redirected, load=load), path, mode)
        ix = index.read_index(spark, path)
        return _top(search.bm25_scores(ix, search.query_terms(benchmark_queries(spark, sf_dir))))
    return materialize(spark, f"search-after-append:{sf_dir}", built)


def segmented_index(spark: SparkSession, sf_dir: str) -> segments.SegmentedIndex:
    """K6 + U1: the sections and redirects of each language, and those of pages without one, as a load of their own."""
    def built() -> DataFrame:
        res = primary(spark, sf_dir)
        path = stage_path(spark, "segmented-index")
        sections = res.redirected.withColumn("source", F.regexp_extract("page", "–([^–]*)$", 1))
        for lang in [r["source"] for r in sections.select("source").distinct().orderBy("source").collect()]:
            part = sections.where(F.col("source") == lang).drop("source")
            segments.add_load(index.build_index(part, res.redirects.select("key", "redirect")), path, lang or "none")
        return spark.createDataFrame([(path,)], "path string")
    return segments.read_segments(spark, materialize(spark, f"segmented-index:{sf_dir}", built).first()["path"])


def search_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + Q12: all terms required, BM25, over an index of one load for each language; the statistics are merged when it is read."""
    return _top(search.bm25_scores(segmented_index(spark, sf_dir), search.query_terms(benchmark_queries(spark, sf_dir))))


def search_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 + Q4: one query for each language of ``documents`` over three fields; top 10.

    ``+sectionTitle:s pageTitle:doc pageTitle:<language> redirsFrom:hub^2 redirsFrom:lead -redirsFrom:cssr``
    """
    langs = corpus.read_table(spark, sf_dir, "documents").where("lang is not null").select(F.col("lang").alias("query_id")).distinct()
    lit = F.lit
    clauses = [("sectionTitle", lit("s"), 1.0, search.MUST), ("pageTitle", lit("doc"), 1.0, search.SHOULD),
               ("pageTitle", F.lower("query_id"), 1.0, search.SHOULD), (index.REDIRS_FIELD, lit("hub"), 2.0, search.SHOULD),
               (index.REDIRS_FIELD, lit("lead"), 1.0, search.SHOULD), (index.REDIRS_FIELD, lit("cssr"), 1.0, search.MUST_NOT)]
    rows = F.array(*[F.struct(lit(field).alias("field"), term.alias("term"), lit(1).alias("qtf"), lit(boost).alias("boost"), lit(occur).alias("occur"))
                     for field, term, boost, occur in clauses])
    return _top(search.tfidf_scores(segmented_index(spark, sf_dir), langs.select("query_id", F.inline(rows))))


# ---------------------------------------------------------------- through the line formats
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the corpus with one damaged record for each document; the damaged ones come back as they are."""
    return dump.dead_letters(corpus.corpus_xml(spark, sf_dir).union(corpus.damaged_xml(spark, sf_dir)))


def dump_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S4 + F11: content records written as one plain dump, redirects and damaged records as a ``.bz2`` one; the primary
    job over both by the split scan. ``branch, records, broken`` from the job itself, and the folder of its sections."""
    def written() -> DataFrame:
        folder = stage_path(spark, "dump-files")
        records = corpus.corpus_xml(spark, sf_dir)
        routed = dump.is_redirect_record()
        records.where(~routed).write.text(f"{folder}/content.xml")
        records.where(routed).union(corpus.damaged_xml(spark, sf_dir)).write.option("compression", "bzip2").text(f"{folder}/rest.xml")
        seen = {"content": Observation(), "redirects": Observation()}
        job = run_primary_records(dump.read_dump_records(spark, [f"{folder}/content.xml", f"{folder}/rest.xml"]), seen=tuple(seen.values()))
        job.redirected.write.parquet(f"{folder}/sections")
        return spark.createDataFrame([(branch, o.get["records"], o.get["broken"], f"{folder}/sections") for branch, o in seen.items()],
                                     "branch string, records bigint, broken bigint, sections string")
    return materialize(spark, f"dump-files:{sf_dir}", written)


def dump_file_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S4: the redirected sections of dump files on disk, one of them packed, with damaged records among them."""
    return spark.read.parquet(dump_files(spark, sf_dir).first()["sections"])


def dump_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """how many records each branch of that job read and how many of them were broken, counted while it ran."""
    return dump_files(spark, sf_dir).select("branch", "records", "broken")


def lines_section_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 -> S7, S9 -> A5-A7, A10: section lines written apart for each language, read back, statistics for each."""
    def written() -> DataFrame:
        res = primary(spark, sf_dir)
        return section_line_files(res.redirected, res.redirects, stage_path(spark, "section-lines"))
    sections = materialize(spark, f"section-lines:{sf_dir}", written)
    return stats.section_stats(sections, by=["source"])


def lines_count_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5, K8, L5 -> S8: redirect-count lines in sorted parts, read back."""
    def written() -> DataFrame:
        path = stage_path(spark, "count-lines")
        lines.write_lines(redirs_count_hist(spark, sf_dir), lines.count_line(), path, num_parts=3, sort_key="redirs_count")
        return lines.read_count_lines(spark, path)
    return materialize(spark, f"count-lines:{sf_dir}", written)


def lines_count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 -> S8, S9: a count file under the name of each language's dump (and of the pages without one), read back by name."""
    def written() -> DataFrame:
        folder = stage_path(spark, "count-files")
        lang = F.regexp_extract("page", "–([^–]*)$", 1)
        named = redirected_sections(spark, sf_dir).withColumn("source", F.concat(F.when(lang == "", F.lit("none")).otherwise(lang), F.lit("wiki.txt")))
        lines.write_count_files(stats.redirs_count_histogram(named, by=["source"]), folder, "source")
        return lines.read_count_files(spark, folder)
    return materialize(spark, f"count-files:{sf_dir}", written)


def lines_staged_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 -> S5: the staged chain with job 1's page lines written and read back before job 2."""
    def written() -> DataFrame:
        path = stage_path(spark, "page-lines")
        lines.write_lines(staged.page_records(staged_pages(spark, sf_dir)), lines.page_line(), path)
        return staged.merged_sections(lines.parse_page_lines(lines.read_lines(spark, path)))
    return materialize(spark, f"page-lines:{sf_dir}", written).select("key", "text")


def lines_staged_redirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4, A4, K2 -> S6 -> F7: redirect groups written as lines and read back before job 4's filter."""
    def written() -> DataFrame:
        path = stage_path(spark, "group-lines")
        sections = materialize(spark, f"staged-sections:{sf_dir}", lambda: staged.merged_sections(
            staged.page_records(staged_pages(spark, sf_dir))))
        groups.write_redirect_groups(explode_redirect_targets(sections), path)
        return staged.redirected_groups(lines.parse_redirect_group_lines(lines.read_lines(spark, path)))
    return materialize(spark, f"group-lines:{sf_dir}", written)


def lines_keyed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs 1-2 over the markup corpus (repeated headings, empty pages, two revisions) as
    keyed lines, read back; a second write to the same place is refused and changes nothing."""
    def written() -> DataFrame:
        path = stage_path(spark, "keyed-lines")
        sections = staged.merged_sections(staged.page_records(dump.parse_page_revisions(corpus.markup_xml(spark, sf_dir))))
        lines.write_lines(sections, lines.keyed_line(), path)
        try:
            lines.write_lines(sections.limit(0), lines.keyed_line(), path)
        except AnalysisException as refused:
            if refused.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        else:
            raise RuntimeError(f"{path} was written twice")
        return lines.parse_keyed_lines(lines.read_lines(spark, path))
    return materialize(spark, f"keyed-lines:{sf_dir}", written)


def lines_section_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K8, L5 -> S7: section lines streamed out member by member, read back as one row for each redirect."""
    def written() -> DataFrame:
        res = primary(spark, sf_dir)
        path = stage_path(spark, "streamed-section-lines")
        groups.write_sections(res.redirected, res.redirects, path, num_parts=8)
        read = lines.parse_section_lines(lines.read_lines(spark, path)).where(~F.col("is_malformed"))
        return read.select("key", "page", "section", F.explode("redirs").alias("redirect"))
    return materialize(spark, f"streamed-section-lines:{sf_dir}", written)


QUERIES = {
    "redirected_sections": redirected_sections,
    "section_redirects": section_redirects,
    "section_stats": section_stats,
    "redirs_count_hist": redirs_count_hist,
    "redirs_hist_30": redirs_hist_30,
    "redirs_hist_100": redirs_hist_100,
    "section_stats_by_lang": section_stats_by_lang,
    "redirs_count_hist_by_lang": redirs_count_hist_by_lang,
    "word_count": word_count,
    "search_tfidf": search_tfidf,
    "search_tfidf_page2": search_tfidf_page2,
    "search_next_page": search_next_page,
    "search_tfidf_bounded": search_tfidf_bounded,
    "search_boolean": search_boolean,
    "search_bm25": search_bm25,
    "search_phrase": search_phrase,
    "search_prefix": search_prefix,
    "search_fuzzy": search_fuzzy,
    "staged_sections": staged_sections,
    "staged_redirected": staged_redirected,
    "link_inversion": link_inversion,
    "prototype_search": prototype_search,
    "stem_vocabulary": stem_vocabulary,
    "normalized_titles": normalized_titles,
    "markup_sections": markup_sections,
    "search_phrase_ranked": search_phrase_ranked,
    "search_mixed": search_mixed,
    "search_must_not": search_must_not,
    "search_wildcard": search_wildcard,
    "search_infix": search_infix,
    "search_range": search_range,
    "search_grouped": search_grouped,
    "search_near": search_near,
    "search_hits": search_hits,
    "search_after_append": search_after_append,
    "search_segments": search_segments,
    "search_fields": search_fields,
    "dead_letters": dead_letters,
    "dump_file_sections": dump_file_sections,
    "dump_file_counts": dump_file_counts,
    "lines_section_stats": lines_section_stats,
    "lines_count_hist": lines_count_hist,
    "lines_count_files": lines_count_files,
    "lines_staged_sections": lines_staged_sections,
    "lines_staged_redirected": lines_staged_redirected,
    "lines_section_redirects": lines_section_redirects,
    "lines_keyed_texts": lines_keyed_texts,
}
