"""MediaWiki XML dump sources.

The splittable path (S1) reads the dump as text records cut at ``</page>``,
so one large file - plain or ``.bz2`` - is spread over many tasks, and each
record is parsed with ``from_xml`` against an explicit schema. The built-in
XML reader (S3) is offered as the convenience path; it reads one file in a
single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Only the elements the jobs look at. A page may hold several revisions.
PAGE_SCHEMA = (
    "title string, redirect struct<_title:string>, "
    "revision array<struct<model:string, text:string>>, _corrupt_record string"
)
XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    # keep leading/trailing spaces of texts, section texts depend on them
    "ignoreSurroundingSpaces": "false",
}


def page_records(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Cut text records into ``<page>...</page>`` strings; drop the dump header and tail."""
    v = F.col(value_col)
    return (raw.where(v.contains("<page>"))
            .select(F.concat(F.regexp_replace(v, r"(?s)^.*?<page>", "<page>"), F.lit("</page>")).alias("xml")))


def parsed_once(records: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Column ``p``: the parsed record, behind a one-row generator.

    Without that barrier every filter on a parsed column is pushed below the
    projection with a copy of ``from_xml``, and the record is parsed again.
    """
    return records.select(F.explode(F.array(F.from_xml(F.col(xml_col), PAGE_SCHEMA, XML_OPTIONS))).alias("p"))


def parse_pages(records: DataFrame, xml_col: str = "xml", keep_corrupt: bool = False, seen: Observation | None = None) -> DataFrame:
    """``title, redirect, model, text`` of each page record, from its first revision.

    ``redirect`` is the redirect element's title attribute (``""`` when the
    element has none), null when the page is no redirect. A page without text
    (no element, or an empty one) has a null text. Records that are not
    well-formed XML are dropped (F11) unless ``keep_corrupt`` is set, in which
    case they come back with ``_corrupt_record`` set - route those to a
    dead-letter table with :func:`corrupt_pages`. ``seen`` gets ``records`` and
    ``broken``, counted by the job that reads the pages.
    """
    first = F.get(F.col("p.revision"), F.lit(0))
    text = first["text"]
    redirect = F.coalesce(F.col("p.redirect._title"), F.when(is_redirect_record(xml_col), F.lit("")))
    parsed = records.select(F.col(xml_col), F.explode(F.array(
        F.from_xml(F.col(xml_col), PAGE_SCHEMA, XML_OPTIONS))).alias("p"))
    out = parsed.select(
        F.col("p.title").alias("title"),
        redirect.alias("redirect"),
        first["model"].alias("model"),
        F.when(text != "", text).alias("text"),
        F.col("p._corrupt_record").alias("_corrupt_record"))
    if seen is not None:
        out = out.observe(seen, F.count(F.lit(1)).alias("records"), F.count("_corrupt_record").alias("broken"))
    if keep_corrupt:
        return out
    return out.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


# Presence of the redirect element, read off the raw record. Markup inside
# texts is escaped, so the tag can only be the element itself.
RAW_REDIRECT_TAG = r"<redirect[\s/>]"


def is_redirect_record(xml_col: str = "xml"):
    """F2 on raw records: route a page before paying for its XML parse."""
    return F.col(xml_col).rlike(RAW_REDIRECT_TAG)


def corrupt_pages(parsed_with_corrupt: DataFrame) -> DataFrame:
    """F11 dead letters: raw text of the records that did not parse."""
    return parsed_with_corrupt.where(F.col("_corrupt_record").isNotNull()).select("_corrupt_record")


def parse_page_revisions(records: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per ``<revision>`` of each page (the staged chain's reading)."""
    return (parsed_once(records, xml_col).where(F.col("p._corrupt_record").isNull())
            .select(F.col("p.title").alias("title"), F.col("p.redirect._title").alias("redirect"),
                    F.explode("p.revision").alias("rev"))
            .select("title", "redirect", F.col("rev.model").alias("model"),
                    F.coalesce(F.col("rev.text"), F.lit("")).alias("text")))


def dead_letters(records: DataFrame, xml_col: str = "xml") -> DataFrame:
    """the records that are not well-formed XML, as they stand in the dump."""
    return parsed_once(records, xml_col).where(F.col("p._corrupt_record").isNotNull()) \
        .select(F.col("p._corrupt_record").alias("record"))


def read_dump_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Splittable scan of one or more dump files (``.xml`` or ``.xml.bz2``, S4)."""
    raw = spark.read.option("lineSep", "</page>").text(paths)
    return page_records(raw)


def read_dump(spark: SparkSession, paths: str | list[str], keep_corrupt: bool = False) -> DataFrame:
    """S1 + S4: pages of a dump as ``title, redirect, model, text``."""
    return parse_pages(read_dump_records(spark, paths), keep_corrupt=keep_corrupt)


def read_dump_revisions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """S2 on files."""
    return parse_page_revisions(read_dump_records(spark, paths))


def read_dump_xml_reader(spark: SparkSession, path: str) -> DataFrame:
    """S3: built-in XML reader with ``rowTag=page`` (single task per file)."""
    df = (spark.read.format("xml").option("rowTag", "page").options(**XML_OPTIONS)
          .schema(PAGE_SCHEMA).load(path).where(F.col("_corrupt_record").isNull()))
    first = F.get(F.col("revision"), F.lit(0))
    return df.select("title", F.col("redirect._title").alias("redirect"), first["model"].alias("model"),
                     F.when(first["text"] != "", first["text"]).alias("text"))
