"""A wiki corpus derived from the driver's ``documents`` table.

The driver's tables hold no wiki markup, so the registered queries first build
wiki pages from every document by plain string building, then run the real
operators on them. The SQL oracle does not re-parse anything: it computes the
expected rows from the parts the markup was built from.

Per document ``d`` (lines = text split on newlines, trimmed, ``=`` removed,
empty ones dropped; ``i`` counts from 0; ``c(i)`` = number of ``.`` in line i):

* content page ``Doc_{d}-{lang}``: line 0, a ``{{Main|Doc_{d+1}-{lang}}}``
  link, then for every ``i >= 1`` a heading ``S_{i}`` of level 2, 3, 4, 2, ...
  and line ``i``;
* ``c(i)`` redirect pages ``R_{d}_{i}_{k}`` to ``Doc_{d}-{lang}#S_{i}``,
  alternately written ``#REDIRECT`` and ``#presmeruj``;
* ``Hub_{d}`` to section ``S_1`` of the document with the smallest id: one
  key that every document points at (the hot key);
* ``Lead_{d}`` to ``#Lead`` (no such section: empty text);
* ``P_{d}`` to the whole page (no section: vanishes);
* ``Css_{d}`` with model ``css`` and a section ``S_1``, and ``Cssr_{d}``
  pointing at it (the page is filtered, so the target comes out empty).

Everything is generated from one narrow pass over ``documents``: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import xml_escape
from ..session import spread

PAGE_COLUMNS = ["title", "text", "model", "redirect"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, lines``: non-empty trimmed lines without ``=``."""
    cleaned = F.transform(F.split(F.col("text"), "\n", -1),
                          lambda x: F.trim(F.replace(x, F.lit("="), F.lit(""))))
    return (docs.where(F.col("text").isNotNull())
            .select("doc_id", "lang", F.filter(cleaned, lambda x: x != "").alias("lines")))


def content_title(doc_id: Column, lang: Column) -> Column:
    return F.concat(F.lit("Doc_"), doc_id.cast("string"), F.lit("-"), lang)


def _heading(i: Column) -> Column:
    level = F.lit(2) + (i - F.lit(1)) % F.lit(3)
    eq = F.repeat(F.lit("="), level)
    return F.concat(eq, F.lit(" S_"), i.cast("string"), F.lit(" "), eq)


def _page(title: Column, text: Column, model: Column | str = "wikitext", redirect: Column | None = None) -> Column:
    model_col = F.lit(model) if isinstance(model, str) else model
    redirect_col = redirect if redirect is not None else F.lit(None).cast("string")
    return F.struct(title.alias("title"), text.alias("text"), model_col.alias("model"),
                    redirect_col.alias("redirect"))


def _redirect_text(keyword: Column | str, target: Column) -> Column:
    kw = F.lit(keyword) if isinstance(keyword, str) else keyword
    return F.concat(kw, F.lit(" [["), target, F.lit("]]"))


def corpus_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All wiki pages of the derived corpus: ``title, text, model, redirect``."""
    docs = read_table(spark, sf_dir, "documents")
    lined = document_lines(spread(docs, spark.sparkContext.defaultParallelism))
    # The hub target: a one-row scalar subquery, evaluated once.
    hub_page = docs.select(F.min_by(content_title(F.col("doc_id"), F.col("lang")), F.col("doc_id"))).scalar()

    d, lang, lines = F.col("doc_id"), F.col("lang"), F.col("lines")
    page = content_title(d, lang)
    ds = d.cast("string")
    lead = F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit(""))
    body = F.array_join(F.transform(lines, lambda line, j: F.when(
        j > 0, F.concat(F.lit("\n"), _heading(j), F.lit("\n"), line)).otherwise(F.lit(""))), "")
    main_link = F.concat(F.lit(" {{Main|"), content_title(d + 1, lang), F.lit("}}"))
    css_title = F.concat(F.lit("Css_"), ds)

    fixed = F.array(
        _page(page, F.concat(lead, main_link, body)),
        _page(F.concat(F.lit("Hub_"), ds), _redirect_text("#REDIRECT", F.concat(hub_page, F.lit("#S_1"))),
              redirect=hub_page),
        _page(F.concat(F.lit("Lead_"), ds), _redirect_text("#REDIRECT", F.concat(page, F.lit("#Lead"))),
              redirect=page),
        _page(F.concat(F.lit("P_"), ds), _redirect_text("#REDIRECT", page), redirect=page),
        _page(css_title, F.concat(F.lit("x\n== S_1 ==\n"), lead), model="css"),
        _page(F.concat(F.lit("Cssr_"), ds), _redirect_text("#REDIRECT", F.concat(css_title, F.lit("#S_1"))),
              redirect=css_title),
    )

    def section_redirects(line: Column, i: Column) -> Column:
        dots = F.length(line) - F.length(F.replace(line, F.lit("."), F.lit("")))
        target = F.concat(page, F.lit("#S_"), i.cast("string"))
        pages = F.transform(F.sequence(F.lit(1), dots), lambda k: _page(
            F.concat(F.lit("R_"), ds, F.lit("_"), i.cast("string"), F.lit("_"), k.cast("string")),
            _redirect_text(F.when(k % 2 == 1, F.lit("#REDIRECT")).otherwise(F.lit("#presmeruj")), target),
            redirect=page))
        return F.when((i > 0) & (dots > 0), pages)

    generated = F.flatten(F.filter(F.transform(lines, section_redirects), lambda a: a.isNotNull()))
    return lined.select(F.inline(F.concat(fixed, generated)))


def pages_to_xml(pages: DataFrame) -> DataFrame:
    """One ``<page>`` XML record per page, as a dump holds them (column ``xml``)."""
    redirect = F.concat(F.lit('<redirect title="'), xml_escape(F.col("redirect")), F.lit('" />'))
    xml = F.concat(
        F.lit("<page><title>"), xml_escape(F.col("title")), F.lit("</title>"),
        F.coalesce(redirect, F.lit("")),
        F.lit("<revision><model>"), xml_escape(F.col("model")), F.lit("</model>"),
        F.lit('<text xml:space="preserve">'), xml_escape(F.col("text")), F.lit("</text></revision></page>"))
    return pages.select(xml.alias("xml"))


def corpus_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as dump records, ready for :func:`wikipassages.sources.dump.parse_pages`."""
    return pages_to_xml(corpus_pages(spark, sf_dir))


def damaged_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each document that is no well-formed XML: its text element is not closed."""
    lined = document_lines(spread(read_table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism))
    lead = F.coalesce(F.try_element_at("lines", F.lit(1)), F.lit(""))
    return lined.select(F.concat(F.lit("<page><title>Broken_"), F.col("doc_id").cast("string"), F.lit("</title><revision><text>"),
                                 xml_escape(lead), F.lit("</revision></page>")).alias("xml"))


# ---------------------------------------------------------------- markup
def raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, i, raw``: a title for every line of every document, written with one kind of markup each.

    The kinds follow each other with ``i``: bold, italic, reference, missing
    citation, comment, link with a label, encoded bytes (two spellings),
    underscores and hyphen, struck and underlined, no markup.
    """
    lined = document_lines(spread(read_table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism))
    rows = lined.select("doc_id", F.posexplode("lines").alias("i", "line"))
    base = F.concat(F.lit("Doc "), F.col("doc_id").cast("string"), F.lit(" L"), F.col("i").cast("string"))
    word = F.concat(F.lit("w"), F.regexp_extract("line", "[a-z]+", 0))
    kinds = [F.concat(F.lit("'''"), base, F.lit("'''")), F.concat(F.lit("''"), base, F.lit("''")),
             F.concat(base, F.lit("<ref>"), word, F.lit("</ref>")), F.concat(base, F.lit("{{cn}}")),
             F.concat(F.lit("<!-- "), word, F.lit(" -->"), base), F.concat(F.lit("[["), base, F.lit("|"), word, F.lit("]]")),
             F.concat(F.lit("Caf%C3%A9 "), base), F.concat(F.lit("Caf.C3.A9 "), base),
             F.concat(F.replace(base, F.lit(" "), F.lit("_")), F.lit("-"), word),
             F.concat(F.lit("<s>"), base, F.lit("</s><u>"), word, F.lit("</u>")), base]
    raw = F.element_at(F.array(*kinds), (F.col("i") % len(kinds) + 1).cast("int"))
    return rows.select("doc_id", "i", raw.alias("raw"))


# Names that redirects of the markup corpus point at, the last without a section.
MARKUP_TARGETS = ["A", "B", "T", "U", "V", "W", "Same", ""]


def markup_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page for each document with all heading levels, a heading of two anchor names and a repeated
    heading, a second revision that must not count, an empty page, and a redirect to every name."""
    lined = document_lines(spread(read_table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism))
    d, lines = F.col("doc_id").cast("string"), F.col("lines")

    def line(k: int) -> Column:
        return F.coalesce(F.try_element_at(lines, F.lit(k + 1)), F.lit(""))

    rest = F.array_join(F.slice(lines, 8, F.greatest(F.size(lines), F.lit(1))), " ")
    heads = ["== {{anchor|A|B}} ==", "=== T ===", "==== U ====", "===== V =====", "====== W ======", "== Same =="]
    body = F.concat(line(0), *[F.concat(F.lit(f"\n{h}\n"), line(k)) for k, h in enumerate(heads, 1)], F.lit("\n== Same ==\n"), rest)

    def record(title: Column, text: Column, redirect: Column | None = None) -> Column:
        element = F.concat(F.lit('<redirect title="'), redirect, F.lit('" />')) if redirect is not None else F.lit("")
        return F.concat(F.lit("<page><title>"), title, F.lit("</title>"), element,
                        F.lit("<revision><model>wikitext</model><text>"), xml_escape(text), F.lit("</text></revision>"),
                        F.lit("<revision><model>wikitext</model><text>== Later ==\nlater</text></revision></page>"))

    page = F.concat(F.lit("M_"), d)
    records = [record(page, body), record(F.concat(F.lit("Empty_"), d), F.lit(""))]
    records += [record(F.concat(F.lit(f"MR_{name}_"), d), _redirect_text("#REDIRECT", F.concat(page, F.lit(f"#{name}"))), page)
                for name in MARKUP_TARGETS]
    return lined.select(F.explode(F.array(*records)).alias("xml"))
