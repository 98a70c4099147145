"""Table-generating operators: pages -> sections.

All of them are array expressions evaluated per row followed by one
``inline``/``explode``: a narrow, map-only stage with no shuffle, so the work
spreads over as many tasks as the input has partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

def nested_sections(pages: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per section of levels 2-6, with its subsections inside its text.

    A level is looked for only inside the sections of the level above, so a
    ``====`` directly under a ``==`` is not found. The text is cut at the
    headings of all levels at once. A fold over their levels says which are
    found: those at most one level below the section that is open there. A
    section ends before the next heading that is no deeper, found or not (one
    that is not found is deeper than every open section).

    Adds ``sec_ord`` (position among the page's sections, level by level),
    ``heading`` (the whole heading match) and ``sec_text``.
    """
    text = F.col(text_col)
    df = (pages
          .withColumn("_heads", F.regexp_extract_all(text, F.lit(T.ANY_HEADING), 0))
          .withColumn("_bodies", F.split(text, T.ANY_HEADING, -1))
          .withColumn("_levels", F.transform("_heads", lambda h: F.length(h) - F.length(F.ltrim(h, F.lit("="))))))
    start = F.struct(F.lit(T.HEADING_LEVELS[0] - 1).alias("open"), F.lit("").alias("found"))
    found = F.aggregate("_levels", start, lambda acc, level: F.when(
        level <= acc["open"] + 1, F.struct(level.alias("open"), F.concat(acc["found"], F.lit("y")).alias("found"))).otherwise(
        F.struct(acc["open"].alias("open"), F.concat(acc["found"], F.lit("n")).alias("found"))), lambda acc: acc["found"])
    # one character for each heading, so that what a section spans is a prefix of the rest of a string
    df = df.withColumn("_found", found).withColumn("_marks", F.array_join(F.col("_levels").cast("array<string>"), ""))
    pieces = F.zip_with("_heads", F.slice("_bodies", 2, F.size("_heads")), lambda h, b: F.concat(h, b))
    df = df.withColumn("_pieces", pieces)

    def section(level: Column, i: Column) -> Column:
        after = F.substring(F.col("_marks"), i + 2, F.size("_heads"))
        deeper = F.substring(F.lit("".join(map(str, T.HEADING_LEVELS))), level, F.lit(len(T.HEADING_LEVELS)))
        inside = F.length(after) - F.length(F.ltrim(after, deeper))
        body = F.concat(F.get("_bodies", i + 1), F.array_join(F.slice("_pieces", i + 2, inside), ""))
        is_found = F.substring(F.col("_found"), i + 1, F.lit(1)) == "y"
        return F.when(is_found, F.struct(level.alias("level"), i.alias("i"), F.get("_heads", i).alias("heading"), body.alias("body")))

    found_sections = F.sort_array(F.array_compact(F.transform("_levels", section)))
    df = df.select(*[c for c in pages.columns if c != text_col], F.posexplode(found_sections).alias("sec_ord", "sec"))
    return df.select(*[c for c in df.columns if c != "sec"],
                     F.col("sec.heading").alias("heading"), F.col("sec.body").alias("sec_text"))


def heading_title(heading: Column | str) -> Column:
    """Heading text without ``=`` and surrounding whitespace."""
    return T.java_trim(F.regexp_replace(T._c(heading), "=", ""))


def section_keys(sections: DataFrame, page_title_col: str = "page_title") -> DataFrame:
    """T3 + C12: one row per anchor name of each section, with its lower-cased key.

    The title is ``page#heading`` run through strip and decode once more (the
    page title already went through them), then anchors are expanded.
    """
    full = T.decode_title(T.strip_title(F.concat(F.col(page_title_col), F.lit("#"), heading_title("heading"))))
    return (sections
            .withColumn("section_title", full)
            .withColumn("key", F.explode(T.extract_anchors(F.col("section_title"))))
            .withColumn("key", F.lower("key")))


def flat_sections(pages: DataFrame, key_col: str = "key", title_col: str = "title",
                  text_col: str = "text") -> DataFrame:
    """Level-2 sections of the staged chain.

    Key is ``title#heading`` with all whitespace removed; the regex eats one
    character before each heading. A page without headings passes through
    whole under its own key. Output: ``key, title, text, sec_ord``.
    """
    pattern = T.STAGED_HEADING
    text = F.col(text_col)
    whole = F.array(F.struct(F.col(key_col).alias("key"), text.alias("text")))

    def cut(names: Column) -> Column:
        bodies = F.slice(F.split(text, pattern, -1), 2, F.size(names))
        found = F.zip_with(names, bodies, lambda n, b: F.struct(
            F.regexp_replace(F.concat(F.col(title_col), F.lit("#"), n), r"\s", "").alias("key"),
            b.alias("text")))
        return F.when(F.size(names) > 0, found).otherwise(whole)
    # most pages (redirects) have no heading: told from the text before the pattern is tried
    secs = F.when(text.contains("=="), T.let(F.regexp_extract_all(text, F.lit(pattern), 1), cut)).otherwise(whole)
    return (pages
            .select(F.posexplode(secs).alias("sec_ord", "s"))
            .select(F.col("s.key").alias("key"), F.col("s.key").alias("title"),
                    F.col("s.text").alias("text"), "sec_ord"))


def explode_redirect_targets(pages: DataFrame, key_col: str = "key", title_col: str = "title",
                             text_col: str = "text") -> DataFrame:
    """T4: one row per section target of a page; the page itself under its own key if none."""
    keys = T.let(T.trimmed_redirect_targets(text_col), lambda targets: F.when(
        F.size(targets) > 0, targets).otherwise(F.array(F.col(key_col))))
    return pages.select(F.explode(keys).alias("key"), F.col(title_col).alias("title"),
                        F.col(text_col).alias("text"))
