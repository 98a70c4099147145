"""Ranked search over the index tables, many queries per job.

Queries are tables, not strings: ``query_terms(query_id, field, term, qtf,
boost, occur)``. A search is ``postings JOIN query_terms ON (field, term)``
(AQE broadcasts the query side when its runtime size allows, else a
skew-aware sort-merge join), then one aggregation per (query, doc) with
partial aggregation, then a top-k per query. The top-k uses ``row_number``
with a rank filter, which Spark plans with a partial group limit before the
shuffle, so a query matching a third of all documents still ships only k rows
per map task.

Scores are rounded to 6 places before ranking; ties go to the smaller doc id.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions import text as T
from ..functions.analysis import STOP_WORDS, analyze, stem_terms
from ..session import dealt, ensure_checkpoint_dir
from ..sources.lines import gather_titles
from . import dictionary, matching
from .index import DEFAULT_FIELD, SearchIndex

SHOULD, MUST, MUST_NOT = "should", "must", "must_not"
# Page size of the interactive search, BM25 parameters.
HITS_PER_PAGE = 10
BM25_K1 = 1.2
BM25_B = 0.75
# The fields a hit can show, in their order, and the presets.
DISPLAY_FIELDS = ("redirsFrom", "pageTitle", "sectionTitle", "sectionText", "redirsCount")
DEFAULT_DISPLAY = ("redirsFrom", "pageTitle", "sectionTitle")
_DISPLAY_COLUMNS = {"redirsFrom": "redirs_from", "pageTitle": "page", "sectionTitle": "section",
                    "sectionText": "text", "redirsCount": "redirs_count"}


# ---------------------------------------------------------------- query tables
def query_terms(queries: DataFrame, field: str = DEFAULT_FIELD, occur: str = SHOULD,
                text_col: str = "text", stop_words=tuple(STOP_WORDS), stem: bool = False,
                boost: float = 1.0, analyzer=None) -> DataFrame:
    """Q3/Q4: analyse query texts into ``query_id, field, term, qtf, boost, occur``."""
    analyzer = analyzer or (lambda c: analyze(c, stop_words))
    toks = (queries.select("query_id", F.explode(analyzer(F.col(text_col))).alias("t"))
            .select("query_id", F.col("t.term").alias("term")))
    if stem:
        toks = stem_terms(toks)
    return (toks.groupBy("query_id", "term").agg(F.count(F.lit(1)).cast("int").alias("qtf"))
            .select("query_id", F.lit(field).alias("field"), "term", "qtf",
                    F.lit(boost).cast("double").alias("boost"), F.lit(occur).alias("occur")))


def phrase_terms(queries: DataFrame, field: str = DEFAULT_FIELD, text_col: str = "text",
                 stop_words=tuple(STOP_WORDS)) -> DataFrame:
    """Q6: every pair of neighbouring terms of each query text as a phrase.

    Output ``query_id, phrase_id, field, term, offset`` where ``offset`` keeps
    the gap a stop word leaves.
    """
    toks = analyze(F.col(text_col), stop_words)
    pairs = F.filter(F.transform(toks, lambda s, i: F.when(i > 0, F.struct(
        i.alias("phrase_id"), F.element_at(toks, i)["term"].alias("t0"), F.lit(0).alias("o0"),
        s["term"].alias("t1"), (s["pos"] - F.element_at(toks, i)["pos"]).alias("o1")))), lambda x: x.isNotNull())
    p = queries.select("query_id", F.inline(pairs))
    return (p.select("query_id", "phrase_id", F.col("t0").alias("term"), F.col("o0").alias("offset"))
            .unionByName(p.select("query_id", "phrase_id", F.col("t1").alias("term"), F.col("o1").alias("offset")))
            .withColumn("field", F.lit(field)))


# ---------------------------------------------------------------- scoring
def _idf_tfidf(n_docs: Column, df: Column) -> Column:
    return F.lit(1.0) + F.log(n_docs / (df + F.lit(1.0)))


def weighted_terms(index: SearchIndex, qterms: DataFrame) -> DataFrame:
    """``qterms`` with ``df`` and ``idf`` of each term (``df`` is null for a term that is not indexed)."""
    n = index.n_docs()
    return (qterms.join(index.term_stats, ["field", "term"], "left")
            .withColumn("idf", _idf_tfidf(n, F.coalesce(F.col("df"), F.lit(0)).cast("double"))))


def _by_document(index: SearchIndex, asked: DataFrame, *more: str) -> DataFrame:
    """The postings of the asked terms (``field, term``; where they lie by document: all), whole documents in one task:
    ``field, term, doc_id, tf, len`` and ``more``.

    Query tables are sent to these tasks (they grow with the queries and the vocabulary, not with the
    text), so what a document gives to a query is united where it lies; matches are never shuffled.
    """
    postings = index.postings.select("field", "term", *index.document, "tf", "len", *more)
    if index.by_document:
        return postings         # what is not asked falls out of the join with the query table that follows; nothing travels before it
    return dealt(postings.join(F.broadcast(asked.select("field", "term").distinct()), ["field", "term"], "left_semi"), "doc_id")


def tfidf_scores(index: SearchIndex, qterms: DataFrame) -> DataFrame:
    """Q5 + Q8: classic TF-IDF with coord and query norm.

    ``score = coord * queryNorm * sum(qtf * sqrt(tf) * idf^2 * boost / sqrt(len))``,
    ``idf = 1 + ln(N / (df + 1))``, ``queryNorm = 1 / sqrt(sum(qtf * (idf * boost)^2))``,
    ``coord = matched clauses / clauses``; must-not clauses neither score nor
    count, a document needs every must clause and none of the must-not ones.
    Output: ``query_id, doc_id, score``.
    """
    qt = weighted_terms(index, qterms)
    scoring = F.col("occur") != MUST_NOT
    qinfo = (qt.groupBy("query_id").agg(
        F.sum(F.when(scoring, F.col("qtf") * (F.col("idf") * F.col("boost")) * (F.col("idf") * F.col("boost")))).alias("sumsq"),
        F.sum(F.when(scoring, F.col("qtf"))).alias("clauses"),
        F.count_if(F.col("occur") == MUST).alias("musts")))
    matched = _by_document(index, qt).join(F.broadcast(qt.select("query_id", "field", "term", "qtf", "idf", "boost", "occur")),
                                           ["field", "term"])
    contrib = F.col("qtf") * F.sqrt("tf") * F.col("idf") * F.col("idf") * F.col("boost") / F.sqrt("len")
    per_doc = matched.groupBy("query_id", *index.document).agg(
        F.sum(F.when(scoring, contrib)).alias("raw"),
        F.sum(F.when(scoring, F.col("qtf"))).alias("hits"),
        F.count_if(F.col("occur") == MUST).alias("must_hits"),
        F.count_if(F.col("occur") == MUST_NOT).alias("forbidden"))
    scored = per_doc.join(F.broadcast(qinfo), "query_id")
    return (scored.where((F.col("forbidden") == 0) & (F.col("must_hits") == F.col("musts"))
                         & (F.coalesce(F.col("hits"), F.lit(0)) > 0))
            .select("query_id", "doc_id",
                    (F.col("raw") / F.sqrt("sumsq") * F.col("hits") / F.col("clauses")).alias("score")))


def bm25_scores(index: SearchIndex, qterms: DataFrame, field: str = DEFAULT_FIELD,
                k1: float = BM25_K1, b: float = BM25_B, require_all: bool = True) -> DataFrame:
    """Q12: BM25 over one field; with ``require_all`` every query term must occur (AND).

    ``idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len / avglen))`` summed
    over the query terms (times their multiplicity), ``idf = ln(N/(df+1)) + 1``.
    """
    n = index.n_docs()
    avg = index.avg_len(field)
    qt = (qterms.where(F.col("field") == field)
          .join(index.term_stats, ["field", "term"], "left")
          .withColumn("idf", F.log(n / (F.coalesce(F.col("df"), F.lit(0)).cast("double") + 1.0)) + 1.0))
    need = qt.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
    matched = _by_document(index, qt).join(F.broadcast(qt.select("query_id", "field", "term", "qtf", "idf")), ["field", "term"])
    tf = F.col("tf").cast("double")
    contrib = F.col("qtf") * F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / avg))
    per_doc = matched.groupBy("query_id", *index.document).agg(F.sum(contrib).alias("score"),
                                                       F.count(F.lit(1)).alias("matched"))
    if require_all:
        per_doc = per_doc.join(F.broadcast(need), "query_id").where(F.col("matched") == F.col("n_terms"))
    return per_doc.select("query_id", "doc_id", "score")


def phrase_matches(index: SearchIndex, phrases: DataFrame, lengths: bool = False) -> DataFrame:
    """Q6: ``query_id, phrase_id, doc_id, freq`` - how often each phrase occurs; with ``lengths`` also ``len``, the field's.

    A phrase occurs at ``start`` when every term sits at ``start + offset``.
    Equal phrases of several queries are looked up once. The asked terms that a
    document holds are gathered into one row where its postings lie; a phrase
    is looked for only in rows that hold its rarest term, and its positions are
    intersected there. So a common term costs a phrase no more than its rarest
    one does, and no posting travels.
    """
    return _phrase_matches(index, phrases, lengths).drop("part")


def _phrase_matches(index: SearchIndex, phrases: DataFrame, lengths: bool) -> DataFrame:
    """The same with each document's ``part``, if the index has parts."""
    own = phrases.groupBy("query_id", "phrase_id", "field").agg(F.array_sort(F.collect_list(F.struct("offset", "term"))).alias("parts"))
    phrase = F.concat_ws(" ", F.col("field"), F.transform("parts", lambda p: F.concat_ws(":", p["offset"].cast("string"), p["term"])))
    own = own.withColumn("phrase", phrase)
    asked = own.select("phrase", "field", "parts").distinct()
    parts = asked.select("phrase", "field", F.inline("parts"))
    rarest = rarest_terms(index, parts, "phrase", "offset").join(asked.select("phrase", "parts"), "phrase")
    held = asked_positions(index, parts)
    first = held.select("field", *index.document, "held", "len", F.explode("held.term").alias("term")).join(F.broadcast(rarest), ["field", "term"])

    def starts(part: Column) -> Column:
        """Where a phrase begins if its ``part`` stands where the value holds it."""
        here = F.flatten(F.filter("held", lambda h: h["term"] == part["term"])["positions"])
        return F.transform(here, lambda x: x - part["offset"])

    rest = F.filter("parts", lambda p: p["offset"] != F.col("offset"))
    begin = starts(F.struct("term", "offset"))
    freqs = first.select("phrase", *index.document, "field", "len", F.size(F.aggregate(rest, begin, lambda acc, p: F.array_intersect(acc, starts(p)))).cast("bigint").alias("freq")) \
        .where("freq > 0").groupBy("phrase", "field", *index.document).agg(F.sum("freq").alias("freq"), F.max("len").alias("len"))
    if lengths and index.values is not None:
        freqs = freqs.drop("len").join(index.field_len, ["doc_id", "field"])
    return freqs.join(F.broadcast(own.select("query_id", "phrase_id", "phrase")), "phrase") \
        .select("query_id", "phrase_id", *index.document, "freq", *(["len"] if lengths else []))


def rarest_terms(index: SearchIndex, parts: DataFrame, name: str, *more: str) -> DataFrame:
    """``name, field, term`` and ``more`` of the rarest term of each group ``name`` of ``field, term``; none if a term is not indexed."""
    terms = F.broadcast(parts.select("field", "term").distinct())
    df = index.term_stats.join(terms, ["field", "term"], "left_semi")
    return parts.join(F.broadcast(df), ["field", "term"], "left").groupBy(name) \
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), *more, "field", "term")).alias("r")) \
        .where("r.df > 0").select(name, "r.field", "r.term", *[f"r.{c}" for c in more])


def asked_positions(index: SearchIndex, asked: DataFrame) -> DataFrame:
    """``field, doc_id, len, held`` (and the document's ``part``) - of each value of each document the asked terms (``field, term``) with their positions."""
    found = index.found_positions().join(F.broadcast(asked.select("field", "term").distinct()), ["field", "term"], "left_semi")
    if not index.by_document or index.values is not None:
        found = dealt(found, "doc_id")
    return found.groupBy(*index.document, "field", "value").agg(
        F.max("len").alias("len"), F.collect_list(F.struct("term", "positions")).alias("held")).select("field", *index.document, "len", "held")


def phrase_scores(index: SearchIndex, phrases: DataFrame) -> DataFrame:
    """Q6 + Q8: phrases as optional clauses, ranked by TF-IDF.

    A phrase weighs the sum of its terms' idf, its frequency stands for tf:
    ``score = coord * sum(sqrt(freq) * idf^2 / sqrt(len)) / sqrt(sum(idf^2))``.
    """
    n = index.n_docs()
    weights = (phrases.join(index.term_stats, ["field", "term"], "left")
               .withColumn("idf", _idf_tfidf(n, F.coalesce(F.col("df"), F.lit(0)).cast("double")))
               .groupBy("query_id", "phrase_id", "field").agg(F.sum("idf").alias("idf")))
    qinfo = weights.groupBy("query_id").agg(F.sum(F.col("idf") * F.col("idf")).alias("sumsq"), F.count(F.lit(1)).alias("clauses"))
    hits = (_phrase_matches(index, phrases, lengths=True).join(F.broadcast(weights), ["query_id", "phrase_id"])
            .groupBy("query_id", *index.document)
            .agg(F.sum(F.sqrt("freq") * F.col("idf") * F.col("idf") / F.sqrt("len")).alias("raw"), F.count(F.lit(1)).alias("matched")))
    return (hits.join(F.broadcast(qinfo), "query_id")
            .select("query_id", "doc_id", (F.col("raw") / F.sqrt("sumsq") * F.col("matched") / F.col("clauses")).alias("score")))


# ---------------------------------------------------------------- expansion
def _vocab_prefixes(index: SearchIndex, asked: DataFrame) -> DataFrame:
    """``field, term, prefix`` for every indexed term, prefixes of the lengths that occur in ``asked.prefix`` only."""
    lengths = asked.select(F.collect_set(F.length("prefix"))).scalar()
    vocab = index.term_stats.select("field", "term")
    return (vocab.select("field", "term", F.explode(lengths).alias("n")).where(F.col("n") <= F.length("term"))
            .select("field", "term", F.expr("substring(term, 1, n)").alias("prefix")))


def expand_prefix(index: SearchIndex, prefixes: DataFrame) -> DataFrame:
    """Q7 prefix ``p*``: ``query_id, clause_id, field, term`` for every indexed term
    starting with ``prefix``. An equi-join on all prefixes of each indexed term
    (the vocabulary grows far slower than the text), no theta join."""
    return (prefixes.join(_vocab_prefixes(index, prefixes), ["field", "prefix"])
            .select("query_id", "clause_id", "field", "term"))


def expand_wildcard(index: SearchIndex, patterns: DataFrame) -> DataFrame:
    """Q7 wildcard: ``query_id, clause_id, field, term`` for terms matching ``pattern``
    (``?`` one character, ``*`` any run, anywhere in it).

    Each distinct pattern is looked up once in the gram postings
    (:func:`.dictionary.matching_terms`), then fanned out to its clauses.
    """
    found = dictionary.matching_terms(index.term_stats, patterns, index.grams)
    return patterns.join(found, ["field", "pattern"]).select("query_id", "clause_id", "field", "term")


def expand_range(index: SearchIndex, ranges: DataFrame) -> DataFrame:
    """Q7 term range ``[lo TO hi]`` (inclusive, by code-point order):
    ``query_id, clause_id, field, term``.

    Each distinct range is looked up once in the sorted dictionary's blocks
    (:func:`.dictionary.terms_between`), then fanned out to its clauses.
    """
    found = dictionary.terms_between(index.term_stats, ranges, index.blocks)
    return ranges.join(found, ["field", "lo", "hi"]).select("query_id", "clause_id", "field", "term")


def _numbered(clauses: DataFrame, *name: str) -> DataFrame:
    """The distinct ``name`` of a clause table with a number ``cid`` for each, from 0 on."""
    ensure_checkpoint_dir(clauses.sparkSession)
    return clauses.select(*name).distinct().coalesce(1).withColumn("cid", F.monotonically_increasing_id().cast("int")).checkpoint()


def _met_clauses(index: SearchIndex, terms: DataFrame, gain: Column | None = None) -> DataFrame:
    """``doc_id, cid, s``: the numbered clauses that each document meets, and the sum of their terms' ``gain``.

    ``terms``: ``cid, field, term`` and what ``gain`` needs, one row for each clause and term. A term's
    clauses travel as one list, whose number of rows is the vocabulary's at most.
    """
    more = [c for c in terms.columns if c not in ("field", "term")]
    lists = terms.groupBy("field", "term").agg(F.collect_list(F.struct(*more)).alias("clauses"))
    met = _by_document(index, lists).join(F.broadcast(lists), ["field", "term"]).select("doc_id", "tf", "len", F.inline("clauses"))
    return met.groupBy("doc_id", "cid").agg(F.sum(F.lit(0.0) if gain is None else gain).alias("s"))


def _fields(clauses: DataFrame) -> list[str]:
    """The fields that clauses ask; each is a field of the index or holds nothing."""
    return [r["field"] for r in clauses.select("field").distinct().collect() if r["field"] is not None]


def _sums(rows, name, *numbers: str) -> tuple[list, np.ndarray, list[np.ndarray]]:
    """Of rows of ``query_id`` and others: the queries, where the rows of each begin, and the columns, sorted by query."""
    rows = sorted((r for r in rows if r["query_id"] is not None), key=lambda r: (r["query_id"], r[name]))
    ids = [r["query_id"] for r in rows]
    starts = np.array([i for i, q in enumerate(ids) if i == 0 or q != ids[i - 1]], np.int64)
    return [ids[i] for i in starts], starts, [np.array([r[c] for r in rows]) for c in (name, *numbers)]


def _nothing(clauses: DataFrame) -> DataFrame:
    return clauses.sparkSession.createDataFrame([], StructType([clauses.schema["query_id"], StructField("doc_id", StringType()), StructField("score", DoubleType())]))


def clause_scores(index: SearchIndex, terms: DataFrame, asked: DataFrame, best: int | None = None, fields: list[str] | None = None) -> DataFrame:
    """Constant-score clauses: coord * matched * queryNorm = matched^2 / clauses^1.5 (every clause weighs 1).

    ``terms``: ``cid, field, term``; ``asked``: ``query_id, cid``, a row for each clause of a query. Queries that ask
    the same have the same clause: a document meets it once, then it counts for each of them. Over an index with
    parts ``best`` leaves out what is not among so many of a query's first hits, and ``fields`` are those of ``terms``.
    """
    if index.parts is not None:
        rows = asked.groupBy("query_id", "cid").agg(F.count(F.lit(1)).alias("times")).collect()
        queries, starts, (cids, count) = _sums(rows, "cid", "times")
        if not queries:
            return _nothing(asked)
        n = np.add.reduceat(count, starts).astype(float)
        scores = matching.Sums(queries, starts, cids, count.astype(np.float32), n ** 1.5, n)
        return matching.scored(index, terms, fields or _fields(terms), scores, int(cids.max()) + 1, asked.schema["query_id"].dataType, best)
    n = asked.groupBy("query_id").agg(F.count(F.lit(1)).alias("clauses"))
    times = asked.groupBy("query_id", "cid").agg(F.count(F.lit(1)).alias("times"))
    hits = (_met_clauses(index, terms).join(F.broadcast(times), "cid")
            .groupBy("doc_id", "query_id").agg(F.sum("times").alias("matched")))
    return (hits.join(F.broadcast(n), "query_id")
            .select("query_id", "doc_id",
                    (F.col("matched") * F.col("matched") / F.pow(F.col("clauses"), 1.5)).alias("score")))


def constant_clause_scores(index: SearchIndex, expanded: DataFrame, clauses: DataFrame) -> DataFrame:
    """Constant-score multi-term clauses. ``clauses``: ``query_id, clause_id``;
    ``expanded``: ``query_id, clause_id, field, term``. Where several queries ask
    the same, prefer :func:`shared_clause_scores`."""
    asked = _numbered(clauses, "query_id", "clause_id")
    terms = expanded.join(asked, ["query_id", "clause_id"]).select("cid", "field", "term").distinct()
    return clause_scores(index, terms, asked)


def shared_clause_scores(index: SearchIndex, clauses: DataFrame, expand, best: int | None = None) -> DataFrame:
    """Constant-score clauses ``query_id, clause_id`` and what ``expand`` (:func:`expand_wildcard`, :func:`expand_range`)
    needs of them; what several clauses ask alike is expanded and met once."""
    what = [c for c in clauses.columns if c not in ("query_id", "clause_id")]
    numbers = _numbered(clauses, *what)
    terms = expand(index, numbers.select(F.lit(0).alias("query_id"), F.col("cid").alias("clause_id"), *what)) \
        .select(F.col("clause_id").alias("cid"), "field", "term")
    return clause_scores(index, terms, clauses.distinct().join(numbers, what).select("query_id", "cid"), best, _fields(numbers))


def prefix_scores(index: SearchIndex, prefixes: DataFrame, best: int | None = None) -> DataFrame:
    """Prefix clauses scored as constant-score clauses; each distinct (field, prefix) is expanded once."""
    return shared_clause_scores(index, prefixes.select("query_id", "clause_id", "field", "prefix"), expand_prefix, best)


def expand_fuzzy(index: SearchIndex, fuzzy: DataFrame, max_edits: int = 2) -> DataFrame:
    """Q7 fuzzy: every indexed term within ``max_edits`` Levenshtein edits of the query term.

    Each distinct query term is looked up once by the dictionary's segments
    (:func:`.dictionary.near_terms`), then fanned out to its clauses.
    Output ``query_id, clause_id, field, qterm, term, edits``.
    """
    matched = dictionary.near_terms(index.term_stats, fuzzy, max_edits)
    return fuzzy.select("query_id", "clause_id", "field", "qterm").join(matched, ["field", "qterm"])


def fuzzy_query_terms(index: SearchIndex, fuzzy: DataFrame, max_edits: int = 2) -> DataFrame:
    """Expanded fuzzy clauses flattened into plain query terms (one OR over all
    expansions); boost = 1 - edits / min(len(q), len(t)). Prefer
    :func:`fuzzy_scores`, which keeps each fuzzy clause nested."""
    e = expand_fuzzy(index, fuzzy, max_edits)
    boost = F.lit(1.0) - F.col("edits") / F.least(F.length("qterm"), F.length("term"))
    return (e.groupBy("query_id", "field", "term").agg(F.max(boost).alias("boost"))
            .select("query_id", "field", "term", F.lit(1).alias("qtf"), "boost", F.lit(SHOULD).alias("occur")))


def fuzzy_scores(index: SearchIndex, fuzzy: DataFrame, max_edits: int = 2, best: int | None = None) -> DataFrame:
    """Q7 fuzzy clauses, each a nested OR of its expansions, scored by TF-IDF.

    ``fuzzy``: ``query_id, clause_id, field, qterm[, qtf]``. A clause's score in
    a document is ``S = sum(boost * sqrt(tf) * idf^2 / sqrt(len))`` over its
    expansions (boost = 1 - edits / min(len(q), len(t))), its weight
    ``W = sum((idf * boost)^2)``, and
    ``score = coord * sum(qtf * S) / sqrt(sum(qtf * W))`` with
    ``coord = matched clauses / clauses``.

    Every distinct (field, qterm) is expanded once and summed once in every
    document, whatever the number of queries that ask it; each of them then
    takes that sum ``qtf`` times. There is no cap on expansions. ``best`` as for :func:`clause_scores`.
    """
    if "qtf" not in fuzzy.columns:
        fuzzy = fuzzy.withColumn("qtf", F.lit(1))
    ensure_checkpoint_dir(fuzzy.sparkSession)
    n = index.n_docs()
    clauses = fuzzy.groupBy("query_id", "field", "qterm").agg(F.sum("qtf").cast("int").alias("qtf"))
    qterms = clauses.select("field", "qterm").distinct()
    one = qterms.select("field", "qterm", F.lit(0).alias("query_id"), F.col("qterm").alias("clause_id"))
    exp = (expand_fuzzy(index, one, max_edits)
           .withColumn("boost", F.lit(1.0) - F.col("edits") / F.least(F.length("qterm"), F.length("term")))
           .join(index.term_stats, ["field", "term"])
           .withColumn("idf", _idf_tfidf(n, F.col("df").cast("double")))
           .select("field", "qterm", "term", "boost", "idf")).checkpoint()
    weight = exp.groupBy("field", "qterm").agg(
        F.sum((F.col("idf") * F.col("boost")) * (F.col("idf") * F.col("boost"))).alias("w"))
    qinfo = (clauses.join(weight, ["field", "qterm"], "left").groupBy("query_id")
             .agg(F.sum(F.col("qtf") * F.coalesce("w", F.lit(0.0))).alias("sumsq"), F.sum("qtf").alias("n_clauses")))

    numbers = _numbered(clauses, "field", "qterm")
    gains = exp.join(numbers, ["field", "qterm"]).select("cid", "field", "term", (F.col("boost") * F.col("idf") * F.col("idf")).alias("gain"))
    asked = clauses.join(numbers, ["field", "qterm"]).select("query_id", "cid", "qtf")
    if index.parts is not None:
        queries, starts, (cids, qtf) = _sums(asked.collect(), "cid", "qtf")
        if not queries:
            return _nothing(clauses)
        info = {r["query_id"]: r for r in qinfo.collect()}
        norm, of = (np.array([float(info[q][c]) for q in queries]) for c in ("sumsq", "n_clauses"))
        scores = matching.Sums(queries, starts, cids, qtf.astype(float), np.sqrt(norm), of, gain=qtf.astype(float))
        return matching.scored(index, gains, _fields(numbers), scores, int(cids.max()) + 1, clauses.schema["query_id"].dataType, best)
    hits = (_met_clauses(index, gains, F.col("gain") * F.sqrt("tf") / F.sqrt("len")).join(F.broadcast(asked), "cid")
            .groupBy("doc_id", "query_id").agg(F.sum(F.col("qtf") * F.col("s")).alias("raw"), F.sum("qtf").alias("matched")))
    return (hits.join(F.broadcast(qinfo), "query_id")
            .select("query_id", "doc_id",
                    (F.col("raw") / F.sqrt("sumsq") * F.col("matched") / F.col("n_clauses")).alias("score")))


# ---------------------------------------------------------------- clauses of several kinds
TERM, PHRASE, PREFIX, WILDCARD, RANGE, FUZZY = "term", "phrase", "prefix", "wildcard", "range", "fuzzy"


@dataclass
class Clauses:
    """Clauses of several kinds over an index, those that queries ask alike as one (``cid``), all without their boost.

    ``asked`` ``query_id, clause_id, cid``; ``parts`` ``cid, part`` (what a clause weighs); ``gains`` ``cid, field, term, gain``
    of all kinds but phrases, without a gain for those of constant score; ``phrases`` ``doc_id, cid, m``, null if none is asked.
    """

    asked: DataFrame
    parts: DataFrame
    gains: DataFrame
    phrases: DataFrame | None
    numbers: DataFrame


def expanded_clauses(index: SearchIndex, keyed: DataFrame, max_edits: int = 2) -> Clauses:
    """``keyed``: ``query_id, clause_id, kind, field, value, value2``. Only kinds that are asked are looked up."""
    n = index.n_docs()
    idf = _idf_tfidf(n, F.coalesce(F.col("df"), F.lit(0)).cast("double"))
    what = ["kind", "field", "value", "value2"]
    named = keyed.withColumn("what", F.to_json(F.struct(*what)))
    numbers = _numbered(named, "what", *what)
    asked = named.select("query_id", "clause_id", "what").join(numbers.select("what", "cid"), "what").select("query_id", "clause_id", "cid")
    kinds = {r["kind"] for r in numbers.select("kind").distinct().collect()}

    def of(*kinds: str) -> DataFrame:
        return numbers.where(F.col("kind").isin(*kinds)).select(F.lit(0).alias("query_id"), F.col("cid").alias("clause_id"), "field", "value", "value2")

    cid = F.col("clause_id").alias("cid")
    stats = index.term_stats
    one, no_gain = F.lit(1.0), F.lit(None).cast("double").alias("gain")
    terms = of(TERM).withColumnRenamed("value", "term").join(stats, ["field", "term"], "left").withColumn("idf", idf)
    parts = terms.select(cid, F.col("idf").alias("part")).union(of(PREFIX, WILDCARD, RANGE).select(cid, one))
    gains = terms.select(cid, "field", "term", (F.col("idf") * F.col("idf")).alias("gain"))
    # multi-term kinds to plain terms
    for kind, expand, names in ((PREFIX, expand_prefix, {"value": "prefix"}), (WILDCARD, expand_wildcard, {"value": "pattern"}),
                                (RANGE, expand_range, {"value": "lo", "value2": "hi"})):
        if kind in kinds:
            gains = gains.union(expand(index, of(kind).withColumnsRenamed(names)).select(cid, "field", "term", no_gain))
    if FUZZY in kinds:
        fuzzy = expand_fuzzy(index, of(FUZZY).withColumnRenamed("value", "qterm"), max_edits) \
            .withColumn("edit_boost", F.lit(1.0) - F.col("edits") / F.least(F.length("qterm"), F.length("term"))) \
            .join(stats, ["field", "term"]).select(cid, "field", "term", (F.col("edit_boost") * idf).alias("part"),
                                                   (F.col("edit_boost") * idf * idf).alias("gain")).checkpoint()
        parts = parts.union(fuzzy.groupBy("cid").agg(F.sqrt(F.sum(F.col("part") * F.col("part")))))
        gains = gains.union(fuzzy.select("cid", "field", "term", "gain"))
    by_phrase = None
    if PHRASE in kinds:
        phrases = of(PHRASE).select("query_id", "clause_id", "field", F.posexplode(F.split("value", " ")).alias("offset", "term"))
        phrase_idf = phrases.join(stats, ["field", "term"], "left").withColumn("idf", idf).groupBy("clause_id").agg(F.sum("idf").alias("part"))
        parts = parts.union(phrase_idf)
        by_phrase = phrase_matches(index, phrases.select("query_id", F.col("clause_id").alias("phrase_id"), "field", "term", "offset"), lengths=True) \
            .withColumnRenamed("phrase_id", "clause_id").join(F.broadcast(phrase_idf), "clause_id") \
            .select("doc_id", cid, (F.sqrt("freq") / F.sqrt("len") * F.col("part") * F.col("part")).alias("m"))
    return Clauses(asked, parts, gains, by_phrase, numbers)


def clause_matches(index: SearchIndex, keyed: DataFrame, max_edits: int = 2) -> tuple[DataFrame, DataFrame]:
    """What clauses of several kinds weigh and where they match, both without their boost.

    ``keyed``: ``query_id, clause_id, kind, field, value, value2``. Returns
    ``query_id, clause_id, part`` and ``query_id, clause_id, doc_id, m`` (see :func:`mixed_scores`).
    """
    c = expanded_clauses(index, keyed, max_edits)
    # all kinds but phrases in one pass over the postings; a clause without a gain is a constant one
    matches = _met_clauses(index, c.gains, F.col("gain") * F.sqrt("tf") / F.sqrt("len")).select("doc_id", "cid", F.coalesce("s", F.lit(1.0)).alias("m"))
    if c.phrases is not None:
        matches = matches.union(c.phrases)
    return c.asked.join(c.parts, "cid").drop("cid"), matches.join(F.broadcast(c.asked), "cid").drop("cid")


def scored_clauses(index: SearchIndex, c: Clauses, scores, query_type, best: int | None) -> DataFrame:
    """``query_id, doc_id, score`` by ``scores`` over an index with parts, all kinds in one pass over its postings."""
    held = {r["cid"]: r["kind"] for r in c.numbers.select("cid", "kind").collect()}
    constant = np.array([k for k, kind in sorted(held.items()) if kind in (PREFIX, WILDCARD, RANGE)], np.int64)
    return matching.scored(index, c.gains, _fields(c.numbers), scores, max(held) + 1, query_type, best, constant, c.phrases)


def mixed_scores(index: SearchIndex, clauses: DataFrame, max_edits: int = 2, best: int | None = None) -> DataFrame:
    """One query with clauses of several kinds (Q3-Q8): ``query_id, doc_id, score``.

    ``clauses``: ``query_id, clause_id, kind, field, value, value2, occur, boost``.
    ``value`` is the term, prefix, pattern, range start or fuzzy term, ``value2``
    the range end; a phrase is given by its terms one space apart, in ``value``.
    Each clause yields a weight w and, in a document, a match m:

    * term: w = boost * idf, m = w * idf * sqrt(tf) / sqrt(len)
    * phrase: the same with the sum of its terms' idf and its frequency as tf
    * prefix, wildcard, range: w = boost, m = boost (constant score)
    * fuzzy: w = boost * sqrt(sum((e * idf)^2)), m = boost * sum(e * idf^2 * sqrt(tf) / sqrt(len))
      over its expansions, e = 1 - edits / min(len(q), len(t))

    ``score = coord * sum(m) / sqrt(sum(w^2))``; a must-not clause neither
    scores nor counts, and a document needs every must clause and none of the
    must-not ones. ``best`` as for :func:`clause_scores`.
    """
    ensure_checkpoint_dir(clauses.sparkSession)
    ids = ["query_id", "clause_id"]
    keyed = clauses.select(*ids, "kind", "field", "value", "value2", "occur", F.col("boost").cast("double").alias("boost"))
    matches = None
    if index.parts is None:
        parts, matches = clause_matches(index, keyed, max_edits)
    else:
        c = expanded_clauses(index, keyed.select(*ids, "kind", "field", "value", "value2"), max_edits)
        parts = c.asked.join(c.parts, "cid").drop("cid")
    heads = keyed.join(parts, ids, "left").withColumn("w", F.col("boost") * F.coalesce("part", F.lit(0.0)))
    scoring = F.col("occur") != MUST_NOT
    qinfo = heads.groupBy("query_id").agg(F.sum(F.when(scoring, F.col("w") * F.col("w"))).alias("sumsq"),
                                          F.count_if(scoring).alias("clauses"), F.count_if(F.col("occur") == MUST).alias("musts"))
    if matches is None:
        kind = clauses.schema["query_id"].dataType
        rows = c.asked.join(keyed, ids).select("query_id", "cid", "occur", "boost").collect()
        queries, starts, (cids, occur, boost) = _sums(rows, "cid", "occur", "boost")
        if not queries:
            return _nothing(clauses)
        info = {r["query_id"]: r for r in qinfo.collect()}
        sumsq, of, musts = (np.array([float(info[q][x] or 0) for q in queries]) for x in ("sumsq", "clauses", "musts"))
        counted = (occur != MUST_NOT).astype(float)
        scores = matching.Sums(queries, starts, cids, counted, np.sqrt(sumsq), of, boost * counted, (occur == MUST).astype(float), 1 - counted, musts)
        return scored_clauses(index, c, scores, kind, best)
    per_doc = matches.join(F.broadcast(keyed.select(*ids, "occur", "boost")), ids).groupBy("query_id", "doc_id").agg(
        F.sum(F.when(scoring, F.col("boost") * F.col("m"))).alias("raw"), F.count_if(scoring).alias("hits"),
        F.count_if(F.col("occur") == MUST).alias("must_hits"), F.count_if(F.col("occur") == MUST_NOT).alias("forbidden"))
    return (per_doc.join(F.broadcast(qinfo), "query_id")
            .where((F.col("forbidden") == 0) & (F.col("must_hits") == F.col("musts")) & (F.col("hits") > 0))
            .select("query_id", "doc_id", (F.col("raw") / F.sqrt("sumsq") * F.col("hits") / F.col("clauses")).alias("score")))


# ---------------------------------------------------------------- ranking and display
def rank_hits(scores: DataFrame, first: int = 1, last: int = HITS_PER_PAGE) -> DataFrame:
    """L1-L3: ranks ``first..last`` of each query (rank 1 = best); paging is a rank range."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    rounded = scores.withColumn("score", F.round("score", 6))
    return (rounded.withColumn("rank", F.row_number().over(w))
            .where((F.col("rank") >= first) & (F.col("rank") <= last)))


def page_of_hits(scores: DataFrame, page: int) -> DataFrame:
    """L2: the ``page``-th page of hits (1-based)."""
    return rank_hits(scores, (page - 1) * HITS_PER_PAGE + 1, page * HITS_PER_PAGE)


def cursor_after(page: DataFrame) -> DataFrame:
    """L2: ``query_id, last_rank, last_score, last_doc`` - where the shown page of each query ends."""
    end = F.max(F.struct("rank", "score", "doc_id")).alias("end")
    return page.groupBy("query_id").agg(end).select("query_id", F.col("end.rank").alias("last_rank"), F.col("end.score").alias("last_score"),
                                                    F.col("end.doc_id").alias("last_doc"))


def page_after(scores: DataFrame, cursor: DataFrame, hits: int = HITS_PER_PAGE) -> DataFrame:
    """L2: the ``hits`` hits behind each query's cursor: ``query_id, rank, doc_id, score, hits_on_page, more``.

    What ranks up to the cursor is dropped before anything is ranked, so a late page costs what the first one does;
    one hit beyond the page tells whether there is ``more``. A query without a cursor starts at its first hit; one
    that has no further hits has no row.
    """
    score = F.round("score", 6)
    behind = F.col("last_rank").isNull() | (F.col("score") < F.col("last_score")) | ((F.col("score") == F.col("last_score")) & (F.col("doc_id") > F.col("last_doc")))
    rest = scores.withColumn("score", score).join(F.broadcast(cursor), "query_id", "left").where(behind)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id")))
    seen = rest.withColumn("place", place).where(F.col("place") <= hits + 1) \
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("query_id")))          # at most hits + 1 rows a query
    return seen.where(F.col("place") <= hits).select(
        "query_id", (F.coalesce("last_rank", F.lit(0)) + F.col("place")).cast("int").alias("rank"), "doc_id", "score",
        F.least("n", F.lit(hits)).cast("int").alias("hits_on_page"), (F.col("n") > hits).alias("more"))


def next_page(scores: DataFrame, hits: int = HITS_PER_PAGE) -> DataFrame:
    """L2: :func:`page_after` behind the first page of ``hits`` hits, with ``scores`` computed once for both pages.

    The hits of both and the one beyond that tells whether there is ``more`` are ranked together and written; the
    cursor and the page behind it come from those few rows for each query.
    """
    ensure_checkpoint_dir(scores.sparkSession)
    ranked = rank_hits(scores, 1, 2 * hits + 1).checkpoint()
    return page_after(ranked.drop("rank"), cursor_after(ranked.where(F.col("rank") <= hits)), hits)


def resolve_display(fields="all") -> list[str]:
    """Q9: ``"all"`` / ``"default"`` / ``"none"`` or an explicit list of field names.

    A name that is no field is reported as a warning and left out.
    """
    if fields == "all":
        return list(DISPLAY_FIELDS)
    if fields == "default":
        return list(DEFAULT_DISPLAY)
    if fields == "none":
        return []
    for name in fields:
        if name not in DISPLAY_FIELDS:
            warnings.warn(f"{name!r} is not a field; fields: {', '.join(DISPLAY_FIELDS)}", stacklevel=2)
    return [f for f in dict.fromkeys(fields) if f in DISPLAY_FIELDS]


def hits_with_fields(index: SearchIndex, ranked: DataFrame, redirects: DataFrame | None = None,
                     fields="all") -> DataFrame:
    """Q9 + Q10: join ranked hits to stored fields; ``hit`` = ``rank. f1█f2█...``.

    ``redirsFrom`` needs the redirect titles of each hit: they are gathered for
    the shown hits only, in two phases (``sources.lines.gather_titles``), and
    tab-terminated as stored.
    """
    shown = resolve_display(fields)
    # the hits are few: they travel, not the stored texts
    out = F.broadcast(ranked).join(index.docs, "doc_id")
    if "redirsFrom" in shown:
        if redirects is None:
            raise ValueError("redirsFrom needs the redirects table")
        titles = (gather_titles(redirects.join(F.broadcast(out.select("key").distinct()), "key", "left_semi"))
                  .select("key", T.tab_terminated("redirs").alias("redirs_from")))
        out = out.join(titles, "key", "left")
    cols = [F.coalesce(F.col(_DISPLAY_COLUMNS[f]).cast("string"), F.lit("")) for f in shown]
    line = F.concat(F.col("rank").cast("string"), F.lit(". "),
                    *[F.concat(c, F.lit(T.HIT_SEP)) for c in cols]) if cols else F.lit(None).cast("string")
    return out.withColumn("hit", line)
