"""The staged chain: dump -> page lines -> level-2 sections -> redirect groups -> filter.

Four MapReduce jobs in the reference, each writing a file; here one lazy plan
with the line-format sinks optional (``sources.lines``).

* job 1 (S2, C10, C11): one record per ``<text>``; newlines to spaces, an
  empty text becomes one space. No model filter, no redirect routing.
* job 2 (T2, C13, A3): level-2 sections keyed ``title#heading`` without
  whitespace; a page without headings passes through whole; records of equal
  key are merged, each text followed by one space.
* job 3 (C6, T4, A4): a record goes under every section it redirects to,
  else under its own key; records are grouped per key.
* job 4 (F7, J2): keep groups with more than one member that hold a member
  titled as the key; output that member's text.

Groups are never gathered: after job 2 keys are unique, so job 4's rule is
"a section some other record redirects to", i.e. a left-semi join of the
sections on the exploded redirect targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sections as S
from ..sources.lines import gather_titles


def page_records(pages: DataFrame) -> DataFrame:
    """Job 1: ``key, title, text`` per revision text (from ``title, text`` rows)."""
    text = T.newlines_to_spaces(F.coalesce(F.col("text"), F.lit("")))
    return pages.select(F.col("title").alias("key"), "title",
                        F.when(text == "", F.lit(" ")).otherwise(text).alias("text"))


def merged_sections(records: DataFrame) -> DataFrame:
    """Job 2: ``key, title, text`` of unique keys; texts of equal keys joined, one space after each."""
    flat = S.flat_sections(records)
    return (flat.groupBy("key")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("sec_ord", "text"))),
                                          lambda s: F.concat(s["text"], F.lit(" "))), "").alias("text"))
            .select("key", F.col("key").alias("title"), "text"))


def redirect_edges(sections: DataFrame) -> DataFrame:
    """Job 3's redirect side: ``target, title`` for every section target of every record."""
    return sections.select(F.explode(T.trimmed_redirect_targets("text")).alias("target"), "title")


def redirected_texts(sections: DataFrame) -> DataFrame:
    """Jobs 3-4: ``key, text`` of every section that some record redirects to (L5 rows).

    A record goes under its own key if it redirects nowhere, or to itself; a
    group needs a second member, so a self-redirect does not make one.
    """
    own = sections.where(T.let(T.trimmed_redirect_targets("text"), lambda targets: (F.size(targets) == 0) | F.array_contains(
        targets, F.col("title")))).select("key", "text")
    edges = redirect_edges(sections).where(F.col("target") != F.col("title"))
    return own.join(edges.select(F.col("target").alias("key")), "key", "left_semi")


def redirected_groups(groups: DataFrame) -> DataFrame:
    """Job 4 on L2 rows (``key, n, pages``): ``key, text`` of the groups with more than one
    member that hold a member titled as the key."""
    own = F.filter("pages", lambda p: p["title"] == F.col("key"))
    found = groups.where(F.col("n") > 1).select("key", F.explode(F.array(own)).alias("own"))        # filtered once
    return found.where(F.size("own") > 0).select("key", F.get("own", F.lit(0))["text"].alias("text"))


def redirect_groups(sections: DataFrame) -> DataFrame:
    """A4 for the L2 line sink: ``key, n, pages array<struct<title,text>>``.

    A whole group becomes one record here, as the line format demands (the
    filter above does not need it); it is gathered in two phases, per
    (key, salt) and then per key, so a hot key is pre-grouped in parallel.
    """
    moved = S.explode_redirect_targets(sections).withColumn("page", F.struct("title", "text"))
    groups = gather_titles(moved, key="key", title="page")
    return groups.select("key", F.size("redirs").alias("n"), F.col("redirs").alias("pages"))
