"""Primary flow: dump -> redirected sections.

``read -> route raw records -> from_xml -> column functions -> inline ->
aggregate both sides per key -> one-to-one left join``. Redirect records and
content records are told apart on the raw text, so each branch parses only
its own pages; the two branches meet in one join on the section key. See
:mod:`wikipassages.operators.redirects` for the shuffle plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import redirects as R
from ..sources import dump


@dataclass
class PrimaryResult:
    """The primary job's outputs, all lazy."""

    redirects: DataFrame    # key, page, section, redirect   (long form, no shuffle)
    sections: DataFrame     # key, page_title, sec_ord, sec_text
    redirected: DataFrame   # key, page, section, n, text


def _finish(redirect_pages: DataFrame, content_pages: DataFrame, compat: bool) -> PrimaryResult:
    redirects = R.section_redirects(R.wikitext_pages(redirect_pages, compat), compat)
    sections = R.section_texts(R.wikitext_pages(content_pages, compat))
    return PrimaryResult(redirects, sections, R.join_redirected_sections(redirects, sections))


def run_primary(pages: DataFrame, compat: bool = False) -> PrimaryResult:
    """From parsed pages ``title, text, model, redirect`` (e.g. a Parquet copy of a dump)."""
    return _finish(pages.where(F.col("redirect").isNotNull()),
                   pages.where(F.col("redirect").isNull()), compat)


def run_primary_records(records: DataFrame, compat: bool = False, xml_col: str = "xml",
                        seen: tuple[Observation, Observation] | None = None) -> PrimaryResult:
    """From raw ``<page>`` records (``sources.dump.read_dump_records`` or the corpus).

    ``seen``: observations of the content and of the redirect records. Whichever job runs a
    branch first fills its one with ``records`` and ``broken`` (F11), without a scan of its own.
    """
    content, redirect = seen or (None, None)
    routed = dump.is_redirect_record(xml_col)
    redirect_pages = dump.parse_pages(records.where(routed), xml_col, seen=redirect).withColumn("is_redirect", F.lit(True))
    content_pages = dump.parse_pages(records.where(~routed), xml_col, seen=content).withColumn("is_redirect", F.lit(False))
    return _finish(redirect_pages, content_pages, compat)
