"""Redirect <-> section operators of the primary job.

Plan shape (one shuffle per side, everything else co-partitioned):

* redirects are aggregated to one row per key with a partial (map-side)
  count, so a key that a third of all redirects point at is pre-reduced in
  every map task before the exchange;
* the per-key counts are left-joined to the section texts, which drops the
  sections nobody points at before their texts are gathered; the text
  aggregation then runs on the join's key partitioning (or map-side of a
  broadcast, when AQE finds the key table small), one row per key on the
  count side, so it cannot skew.

Per-key lists of redirect titles are deliberately not built here: the titles
stay a long (key, redirect) table, which needs no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import sections as S


def computed_once(df: DataFrame, **columns) -> DataFrame:
    """Select ``columns`` through a one-row generator: an optimisation barrier
    that keeps later filters from re-evaluating expensive expressions."""
    return df.select(F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def wikitext_pages(pages: DataFrame, compat: bool = False) -> DataFrame:
    """F1 + F2 + C9 + C10: wikitext pages with normalised title and one-line text.

    Input columns: ``title, text, model, redirect`` (redirect = target title
    or null) and optionally ``is_redirect`` (when the caller routed the raw
    records already). Output adds ``page_title``, ``flat_text``, ``is_redirect``.
    """
    routed = F.col("is_redirect") if "is_redirect" in pages.columns else F.col("redirect").isNotNull()
    return (pages
            .where(F.col("model") == "wikitext")
            .select("title", "redirect",
                    T.normalize_title(F.col("title"), compat).alias("page_title"),
                    T.newlines_to_spaces(F.coalesce(F.col("text"), F.lit(""))).alias("flat_text"),
                    routed.alias("is_redirect")))


def section_redirects(norm_pages: DataFrame, compat: bool = False) -> DataFrame:
    """One row per redirect to a section.

    Columns: ``key, page, section, redirect`` where ``redirect`` is the
    redirecting page's own (normalised, not lower-cased) title.
    """
    target = T.normalize_title(T.redirect_section_target(F.col("flat_text"), compat), compat)
    # computed once behind a generator, so the filters below cannot be pushed
    # under it with a copy of the whole normalisation
    rows = computed_once(norm_pages.where(F.col("is_redirect")), key=F.lower(target),
                         redirect=F.col("page_title")).where(F.col("key") != "")
    valid, page, section = T.split_section_key("key")
    return rows.where(valid).select("key", page.alias("page"), section.alias("section"), "redirect")


def section_texts(norm_pages: DataFrame) -> DataFrame:
    """T1 + C12 + T3 on content pages: ``key, page_title, sec_ord, sec_text``."""
    content = norm_pages.where(~F.col("is_redirect")).select("page_title", F.col("flat_text").alias("text"))
    keyed = S.section_keys(S.nested_sections(content, "text"), "page_title")
    return keyed.select("key", "page_title", "sec_ord", "sec_text")


def join_redirected_sections(redirects: DataFrame, sections: DataFrame) -> DataFrame:
    """J1 + A1 + A2 (count): every redirect target with its section text.

    Left outer from redirects: a target whose section does not exist keeps an
    empty text; sections nobody points at vanish (F5). Texts of equal keys are
    concatenated in (page title, section position) order.
    Columns: ``key, page, section, n, text``.
    """
    # One row per key with a partial (map-side) count: a key that a third of
    # all redirects point at is pre-reduced in every task before the shuffle.
    per_key = redirects.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("n"))
    # The left join keeps every target and drops unwanted sections before
    # their texts are gathered; the aggregation reuses the join's key
    # partitioning (or, if AQE broadcasts the keys, sections are filtered
    # map-side). The redirect branch is evaluated once.
    piece = F.when(F.col("sec_text").isNotNull(), F.struct("page_title", "sec_ord", "sec_text"))
    texts = (per_key.join(sections, "key", "left")
             .groupBy("key", "n")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda s: s["sec_text"]), "")
                  .alias("text")))
    _, page, section = T.split_section_key("key")
    return texts.select("key", page.alias("page"), section.alias("section"), "n", "text")
