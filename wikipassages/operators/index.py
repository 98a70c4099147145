"""Inverted index as ordinary tables.

* ``docs``       doc_id, key, page, section, text, redirs_count, char_count  (stored fields)
* ``postings``   field, term, doc_id, tf, len, positions     (len = tokens of the doc's field;
                 positions = sorted token positions, for phrase queries)
* ``term_stats`` field, term, df
* ``field_len``  doc_id, field, len                          (one row per doc and field)
* ``values``     field, term, doc_id, value, positions       (fields of many values: one row per
                 term and value, positions inside the value)

The documents are dealt out by id before they are analysed. The field length is
computed inside each row (size of its token array), and so are ``tf`` and the
position list: runs of the document's sorted tokens, without a shuffle or a sort
of token rows. Redirect titles (``redirsFrom``) come from the long
(key, redirect) table: their tokens are counted per (doc, term) and per doc
with partial aggregation, so a section that a third of all redirects point at
is pre-reduced in every task and never gathered into one list. Their positions
stay with each title (``values``), so a phrase is found inside one title.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.analysis import STOP_WORDS, analyze, stem_terms
from ..functions.text import let
from ..session import dealt
from . import stats

# Searchable fields of a section document.
TEXT_FIELDS = ("pageTitle", "sectionTitle", "sectionText")
REDIRS_FIELD = "redirsFrom"
DEFAULT_FIELD = "sectionText"


@dataclass
class SearchIndex:
    docs: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    field_len: DataFrame
    values: DataFrame | None = None
    grams: DataFrame | None = None          # field, gram, term (``dictionary.term_grams``); made on the fly if absent
    blocks: DataFrame | None = None         # field, term, part, block (``dictionary.term_blocks``); made on the fly if absent

    by_document: bool = False               # the postings are a table bucketed by ``doc_id`` or by ``part``
    parts: DataFrame | None = None          # part, field, term, n: the dictionary of each part of the documents (``part_terms``); the postings have a ``part``
    part_of: Column | None = None           # the part of a ``doc_id`` (``matching.part_of``), if the postings have one

    @property
    def document(self) -> list[str]:
        """Columns that name a document where postings lie; what is grouped by them stays there."""
        return ["doc_id"] if self.parts is None else ["part", "doc_id"]

    def found_positions(self) -> DataFrame:
        """``field, term, doc_id, value, positions, len`` of all fields; ``value`` is 0 where a field has one value, ``len`` null where it has many."""
        whole = self.postings.where(F.col("positions").isNotNull()).select(
            "field", "term", *self.document, F.lit(0).cast("bigint").alias("value"), "positions", "len")
        return whole if self.values is None else whole.unionByName(self.values, allowMissingColumns=True)

    def n_docs(self):
        """Number of documents, as a scalar-subquery column."""
        return self.docs.select(F.count(F.lit(1)).cast("double")).scalar()

    def avg_len(self, field: str):
        """Mean token count of ``field`` over all documents (scalar-subquery column)."""
        total = self.field_len.where(F.col("field") == field).select(F.sum("len").cast("double")).scalar()
        return F.try_divide(F.coalesce(total, F.lit(0.0)), self.n_docs())


def _tokens(df: DataFrame) -> DataFrame:
    """``doc_id, field, len, pos, term`` from ``doc_id, field, toks``."""
    return (df.withColumn("len", F.size("toks"))
            .select("doc_id", "field", "len", F.explode("toks").alias("t"))
            .select("doc_id", "field", "len", F.col("t.pos").alias("pos"), F.col("t.term").alias("term")))


#: Repeated terms of a text up to which each is looked for apart; with more of them its tokens are sorted.
FEW_REPEATED = 32


def _grouped(toks: Column) -> Column:
    """``array<struct<term, tf, positions>>`` of a document's tokens (null without any).

    Documents are grouped inside their row, since a grouping of token rows would sort them all with their keys. Most terms of a
    section stand in it once and are postings as they are; only repeated ones have their positions gathered.
    """
    def single(v: Column) -> Column:
        return F.transform(v, lambda t: F.struct(t["term"].alias("term"), F.lit(1).alias("tf"), F.array(t["pos"]).alias("positions")))

    def few(v: Column, repeated: Column) -> Column:
        once = single(F.filter(v, lambda t: ~F.array_contains(repeated, t["term"])))
        return let(F.filter(v, lambda t: F.array_contains(repeated, t["term"])), lambda again: F.concat(once, F.transform(repeated, lambda term: let(
            F.sort_array(F.filter(again, lambda t: t["term"] == term)["pos"]),
            lambda at: F.struct(term.alias("term"), F.size(at).alias("tf"), at.alias("positions"))))))

    def of(v: Column) -> Column:
        repeated = let(F.sort_array(v["term"]), lambda terms: F.array_distinct(F.filter(terms, lambda x, i: x == F.get(terms, i + 1))))
        return let(repeated, lambda r: F.when(F.size(r) == 0, single(v)).when(F.size(r) <= FEW_REPEATED, few(v, r)).otherwise(_sorted_runs(v)))
    return F.when(F.size(toks) > 0, let(toks, of))


def _sorted_runs(toks: Column) -> Column:
    """The same for any number of repeated terms: sorted by term and position, a posting is a run."""
    def runs(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["term"] != F.get(s, i - 1)["term"]))
        return let(first, lambda at: F.transform(at, lambda i, k: let(F.slice(s, i + 1, F.coalesce(F.get(at, k + 1), F.size(s)) - i), lambda run: F.struct(
            F.get(s, i)["term"].alias("term"), F.size(run).alias("tf"), F.transform(run, lambda t: t["pos"]).alias("positions")))))
    return let(F.sort_array(F.transform(toks, lambda t: F.struct(t["term"].alias("term"), t["pos"].alias("pos")))), runs)


def _stem_postings(postings: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Q11 on the postings of ``fields``: stem each distinct term once, then merge
    the postings of terms that share a stem (tf summed, positions united).
    Works on (term, doc) rows rather than on every token."""
    plain = postings.where(~F.col("field").isin(*fields))
    stemmed = stem_terms(postings.where(F.col("field").isin(*fields)))
    return plain.unionByName(dealt(stemmed, "doc_id").groupBy("field", "term", "doc_id", "len")
            .agg(F.sum("tf").cast("int").alias("tf"),
                 F.array_sort(F.flatten(F.collect_list(F.coalesce("positions", F.array().cast("array<int>")))))
                 .alias("positions"),
                 F.max(F.col("positions").isNull().cast("int")).alias("_nopos"))
            .withColumn("positions", F.when(F.col("_nopos") == 1, F.lit(None).cast("array<int>"))
                        .otherwise(F.col("positions")))
            .drop("_nopos").select(*postings.columns))


def build_field_index(docs: DataFrame, fields: dict[str, str], analyzer=None, stem: bool | tuple[str, ...] = False,
                      extra: DataFrame | None = None, by_document: bool = False) -> SearchIndex:
    """Index ``docs`` (must hold ``doc_id``): one text field per entry of ``fields``
    (field name -> column). ``analyzer`` maps a text column to
    ``array<struct<pos,term>>`` (default: letters, lower case, stop words).
    ``stem``: names of the fields to stem (true: all of ``fields``).
    ``extra``: an optional ``doc_id, field, text`` table of further values of a
    field (many rows per document allowed), counted without gathering them.
    ``by_document``: ``docs`` lie dealt by ``doc_id`` already (a bucketed table).
    """
    analyzer = analyzer or analyze
    lying = docs if by_document else dealt(docs, "doc_id")
    # rows of equal key are put together as texts, before they are tokens
    copies = lying.groupBy("doc_id").agg(F.collect_list(F.struct(*[F.col(src).alias(name) for name, src in fields.items()])).alias("copies"))

    def of_field(name: str) -> Column:
        """``array<struct<field, len, toks>>``: rows of equal key and length are one document."""
        def united(all_toks: Column) -> Column:
            return F.transform(F.array_distinct(F.transform(all_toks, lambda t: F.size(t))), lambda n: F.struct(
                F.lit(name).alias("field"), n.alias("len"), F.flatten(F.filter(all_toks, lambda t: F.size(t) == n)).alias("toks")))

        first = let(analyzer(F.col("copies")[0][name]), lambda t: F.array(F.struct(F.lit(name).alias("field"), F.size(t).alias("len"), t.alias("toks"))))
        return F.when(F.size("copies") == 1, first).otherwise(let(F.transform("copies", lambda c: analyzer(c[name])), united))

    per_field = copies.select("doc_id", F.inline(F.flatten(F.array(*[of_field(name) for name in fields]))))
    postings = per_field.select("field", "doc_id", "len", F.inline(_grouped(F.col("toks"))))
    arr = F.array(*[F.struct(F.lit(name).alias("field"), F.size(analyzer(F.col(src))).alias("len")) for name, src in fields.items()])
    field_len = docs.select("doc_id", F.inline(arr)).select("doc_id", "field", "len")

    values = None
    if extra is not None:
        titles = extra.select("doc_id", "field", F.xxhash64("text").alias("value"), analyzer(F.col("text")).alias("toks")).distinct()
        values = (titles.select("doc_id", "field", "value", F.explode("toks").alias("t"))
                  .groupBy("field", F.col("t.term").alias("term"), "doc_id", "value")
                  .agg(F.array_sort(F.collect_list("t.pos")).alias("positions")))
        more = _tokens(extra.select("doc_id", "field", analyzer(F.col("text")).alias("toks")))
        more_tf = (more.groupBy("field", "term", "doc_id").agg(F.count(F.lit(1)).cast("int").alias("tf"))
                   .withColumn("positions", F.lit(None).cast("array<int>")))
        # lengths from the counts: the titles are tokenised once
        more_len = more_tf.groupBy("doc_id", "field").agg(F.sum("tf").cast("int").alias("len"))
        postings = postings.unionByName(dealt(more_tf.join(more_len, ["doc_id", "field"]), "doc_id"))
        field_len = field_len.unionByName(more_len.select("doc_id", "field", "len"))

    postings = postings.select("field", "term", "doc_id", "tf", "len", "positions")
    if stem:
        postings = _stem_postings(postings, tuple(fields) if stem is True else tuple(stem))
    return SearchIndex(docs, postings, term_frequencies(postings), field_len, values)


#: Between a document's key and what tells equal keys of several sources or loads apart.
ID_SEP = "\u241f"


def build_index(sections: DataFrame, redirects: DataFrame | None = None,
                stop_words=tuple(STOP_WORDS), stem: bool | tuple[str, ...] = False, source: str | None = None,
                load: str | None = None, by_key: bool = False) -> SearchIndex:
    """Index the indexable sections (F8) of the primary job.

    ``sections``: ``key, page, section, n, text``; ``redirects``: the long
    ``key, redirect`` table (optional; without it ``redirsFrom`` is empty).
    ``source``: column of both that names the input (U1); sections of equal
    key from two sources are separate documents. ``load``: name of this run of
    the indexer, for an index that is appended to: documents of two loads are
    separate, too. Without both, ``doc_id`` is the key. ``by_key``: ``sections``
    is a table bucketed by ``key``, so its texts need not be dealt out again.
    """
    def doc_id(key):
        parts = [key] + ([F.col(source).cast("string")] if source else []) + ([F.lit(load)] if load else [])
        return F.concat_ws(ID_SEP, *parts) if len(parts) > 1 else key

    docs = stats.indexable(sections).select(
        doc_id(F.col("key")).alias("doc_id"), "key", "page", "section", "text", F.col("n").alias("redirs_count"),
        F.length("text").alias("char_count"))
    extra = None
    if redirects is not None:
        extra = (redirects.select(doc_id(F.col("key")).alias("doc_id"), F.lit(REDIRS_FIELD).alias("field"), F.col("redirect").alias("text"))
                 .join(docs.select("doc_id"), "doc_id", "left_semi"))
    return build_field_index(docs, dict(zip(TEXT_FIELDS, ("page", "section", "text"))),
                             lambda c: analyze(c, stop_words), stem, extra, by_key and source is None and load is None)


def term_frequencies(postings: DataFrame) -> DataFrame:
    """Document frequency per (field, term); partial aggregation per task."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def part_terms(postings: DataFrame) -> DataFrame:
    """``part, field, term, n``: the terms of each part's documents with their frequencies in it."""
    return postings.groupBy("part", "field", "term").agg(F.count(F.lit(1)).alias("n"))


def field_lengths(postings: DataFrame) -> DataFrame:
    """``doc_id, field, len`` recovered from postings (fields without tokens are
    absent; they add nothing to summed lengths)."""
    part = [c for c in ("part",) if c in postings.columns]
    return postings.select(*part, "doc_id", "field", "len").distinct().drop("part")


def write_index(index: SearchIndex, path: str, mode: str = "append") -> None:
    """K6/K7: store the index tables as Parquet under ``path``.

    ``append`` adds documents like re-running the indexer on more files; give
    each appended index a ``load`` name, so that its documents are not taken
    for those already there
    (``term_stats`` must then be rebuilt with :func:`rebuild_term_stats`);
    ``overwrite`` replaces the index. Postings and lengths are
    partitioned by field, so a search on one field reads one directory.
    """
    index.docs.write.mode(mode).parquet(f"{path}/docs")
    index.postings.write.mode(mode).partitionBy("field").parquet(f"{path}/postings")
    index.field_len.write.mode(mode).partitionBy("field").parquet(f"{path}/field_len")
    values = index.values if index.values is not None else index.found_positions().drop("len").limit(0)
    values.write.mode(mode).partitionBy("field").parquet(f"{path}/values")
    rebuild_term_stats(index.docs.sparkSession, path)


def rebuild_term_stats(spark, path: str) -> None:
    postings = spark.read.parquet(f"{path}/postings")
    term_frequencies(postings).write.mode("overwrite").parquet(f"{path}/term_stats")


def read_index(spark, path: str) -> SearchIndex:
    r = spark.read
    values = spark.read.schema("term string, doc_id string, value bigint, positions array<int>, field string").parquet(f"{path}/values")
    return SearchIndex(r.parquet(f"{path}/docs"), r.parquet(f"{path}/postings"), r.parquet(f"{path}/term_stats"),
                       r.parquet(f"{path}/field_len"), values)
