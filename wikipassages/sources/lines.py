"""Readers and writers of the reference's line formats.

Fields are separated by three U+2588 (``███``) and the key by a tab. Java's
``split`` drops trailing empty parts, so trailing separators are cut before
splitting. All readers are ``spark.read.text`` plus column expressions
(splittable, no Python); all writers are one ``concat`` column and
``write.text``.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import FIELD_SEP, drop_trailing

_SEP_RE = FIELD_SEP  # no regex metacharacters in it


def _parts(value: Column) -> Column:
    return F.split(drop_trailing(value, _SEP_RE), _SEP_RE, -1)


def _with_parts(lines: DataFrame) -> DataFrame:
    """``_parts`` of each line, behind a one-row generator: a line (a group of millions of members may
    stand on one) is split once, not for each column, filter or member that looks into it."""
    return lines.select("*", F.explode(F.array(_parts(F.col("value")))).alias("_parts"))


def _key_fields(head: Column) -> Column:
    return F.split(drop_trailing(head, "\t"), "\t", -1)


def read_lines(spark: SparkSession, paths: str | list[str], with_file: bool = False) -> DataFrame:
    """``value`` (and ``source_file`` with ``with_file``, S9) of text files."""
    df = spark.read.text(paths)
    if with_file:
        df = df.select("value", F.col("_metadata.file_path").alias("source_file"))
    return df


# ---------------------------------------------------------------- readers
def parse_page_lines(lines: DataFrame) -> DataFrame:
    """S5 (L1): ``key, title, text``; key and title are the title field, a missing text is ``""``."""
    parts = F.col("_parts")
    title = F.try_element_at(_key_fields(parts.getItem(0)), F.lit(2))
    return _with_parts(lines).select(title.alias("key"), title.alias("title"),
                        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("text"),
                        *[c for c in lines.columns if c != "value"])


def parse_redirect_group_lines(lines: DataFrame) -> DataFrame:
    """S6 (L2): ``key, n, pages array<struct<title,text>>``; a missing last text is ``""``."""
    parts = F.col("_parts")
    kf = _key_fields(parts.getItem(0))
    n = F.coalesce(F.try_element_at(kf, F.lit(2)).try_cast("int"), F.lit(0))
    pages = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.try_element_at(parts, i * 2 + 2).alias("title"),
        F.coalesce(F.try_element_at(parts, i * 2 + 3), F.lit("")).alias("text")))).otherwise(
        F.array().cast("array<struct<title:string,text:string>>"))
    return _with_parts(lines).select(kf.getItem(0).alias("key"), n.alias("n"), pages.alias("pages"))


def parse_section_lines(lines: DataFrame, seen: Observation | None = None) -> DataFrame:
    """S7 (L3) + F8: ``key, page, section, n, redirs, text, is_malformed``.

    A line is indexable when it has more than 4 parts and exactly ``4 + n``
    (so an empty text, which Java's split drops, is not). A line with more
    than 4 parts that is not indexable, or whose count is not a number, is
    marked ``is_malformed`` (the dead-letter rows), and so is one without a tab
    before its page; shorter lines are skipped. ``seen`` gets ``lines`` and
    ``malformed``, counted by the job that reads the rows.
    """
    parts = F.col("_parts")
    size = F.size(parts)
    n = F.try_element_at(parts, F.lit(3)).try_cast("int")
    head = _key_fields(parts.getItem(0))
    page = F.try_element_at(head, F.lit(2))
    valid = n.isNotNull() & (size == n + 4) & page.isNotNull()
    df = _with_parts(lines).where(size > 4).select(
        F.try_element_at(head, F.lit(1)).alias("key"),
        page.alias("page"),
        F.try_element_at(parts, F.lit(2)).alias("section"),
        n.alias("n"),
        F.when(valid, F.slice(parts, 4, F.greatest(n, F.lit(0)))).alias("redirs"),
        F.when(valid, F.try_element_at(parts, size)).alias("text"),
        (~valid).alias("is_malformed"),
        *[c for c in lines.columns if c != "value"],
        F.col("value").alias("raw"))
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if("is_malformed").alias("malformed"))
    return df


def parse_keyed_lines(lines: DataFrame) -> DataFrame:
    """The L5 lines read back: ``key, text``, cut at the first tab; a line without one is a key with an empty text."""
    key = F.substring_index("value", "\t", 1)
    return lines.select(key.alias("key"), F.expr("substring(value, length(substring_index(value, '\t', 1)) + 2)").alias("text"),
                        *[c for c in lines.columns if c != "value"])


def read_count_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """S8 (L4): ``redirs_count int, freq bigint`` (fields split on any whitespace)."""
    parts = F.split(F.trim(F.col("value")), r"\s+", -1)
    return (spark.read.text(paths).where(F.trim("value") != "")
            .select(parts.getItem(0).try_cast("int").alias("redirs_count"),
                    F.try_element_at(parts, F.lit(2)).try_cast("bigint").alias("freq")))


# ---------------------------------------------------------------- line builders
def page_line(key: str = "key", title: str = "title", text: str = "text") -> Column:
    """K1 (L1)."""
    return F.concat(F.col(key), F.lit("\t"), F.col(title), F.lit(FIELD_SEP), F.col(text))


def redirect_group_line(key: str = "key", pages: str = "pages") -> Column:
    """K2 (L2)."""
    body = F.array_join(F.transform(F.col(pages), lambda p: F.concat(
        F.lit(FIELD_SEP), p["title"], F.lit(FIELD_SEP), p["text"])), "")
    return F.concat(F.col(key), F.lit("\t"), F.size(pages).cast("string"), body)


def section_line(key: str = "key", page: str = "page", section: str = "section",
                 redirs: str = "redirs", text: str = "text") -> Column:
    """K3 (L3)."""
    rs = F.array_join(F.transform(F.col(redirs), lambda r: F.concat(F.lit(FIELD_SEP), r)), "")
    return F.concat(F.col(key), F.lit("\t"), F.col(page), F.lit(FIELD_SEP), F.col(section), F.lit(FIELD_SEP),
                    F.size(redirs).cast("string"), rs, F.lit(FIELD_SEP), F.col(text))


def keyed_line(key: str = "key", text: str = "text") -> Column:
    """K4 (L5)."""
    return F.concat(F.col(key), F.lit("\t"), F.col(text))


def count_line(count: str = "redirs_count", freq: str = "freq") -> Column:
    """K5 (L4)."""
    return F.concat(F.col(count).cast("string"), F.lit("\t"), F.col(freq).cast("string"))


SALT_BUCKETS = 64


def gather_titles(redirects: DataFrame, key: str = "key", title: str = "redirect") -> DataFrame:
    """``key, redirs`` (sorted titles) for formats that put a whole group on one line.

    Gathered in two phases - per (key, salt) in parallel, then the partial
    lists per key - so a key holding a third of all rows is pre-grouped by
    many tasks before its lists meet. Only the line sinks and hit display
    use it; everything else works on the long table.
    """
    salted = redirects.withColumn("_salt", F.pmod(F.xxhash64(title), F.lit(SALT_BUCKETS)))
    partial = salted.groupBy(key, "_salt").agg(F.collect_list(title).alias("_part"))
    return partial.groupBy(key).agg(F.sort_array(F.flatten(F.collect_list("_part"))).alias("redirs"))


def sections_with_redirs(redirected: DataFrame, redirects: DataFrame) -> DataFrame:
    """Attach each section's sorted redirect titles for the L3 sink (see :func:`gather_titles`)."""
    return redirected.join(gather_titles(redirects), "key", "left").withColumn(
        "redirs", F.coalesce("redirs", F.array().cast("array<string>")))


# ---------------------------------------------------------------- writer
def write_lines(df: DataFrame, line: Column, path: str, mode: str = "errorifexists",
                num_parts: int | None = None, sort_key: str | None = None,
                compression: str | None = None, partition_by: str | None = None) -> None:
    """Write one line per row (K1-K5).

    ``mode`` defaults to refusing an existing output (K9). ``num_parts``
    hash-partitions by ``sort_key`` into that many files (K8), and each file
    is sorted by it (L5), like a reducer's output.
    """
    out = df.select(line.alias("value"), *([F.col(sort_key).alias("_k")] if sort_key else []),
                    *([F.col(partition_by)] if partition_by else []))
    if num_parts:
        out = out.repartition(num_parts, "_k") if sort_key else out.repartition(num_parts)
    if sort_key:
        out = out.sortWithinPartitions("_k").drop("_k")
    writer = out.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.text(path)


#: Fixed value: what an input's name is followed by in the name of its count file.
COUNT_FILE = "redirsCount.txt"


def write_count_files(counts: DataFrame, folder: str, source: str = "source_file") -> list[str]:
    """K5: one count file for each input, ``<input>redirsCount.txt`` under ``folder``; returns the names, sorted.

    ``counts``: ``source, redirs_count, freq``. A source's lines (as many as it has different counts) are written by
    one task, sorted; when the job has committed, each file gets its name by a rename in the folder's own store, so
    a file under its name is whole. A file that is there already raises (K9) before anything is written.
    """
    spark = counts.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def child(parent, name: str):
        return spark._jvm.org.apache.hadoop.fs.Path(parent, name)
    names = sorted(f"{r[0]}{COUNT_FILE}" for r in counts.select(source).distinct().collect())          # one row an input
    taken = [n for n in names if fs.exists(child(root, n))]
    if taken:
        raise FileExistsError(f"{folder}: {', '.join(taken)}")
    draft = child(root, f"_counts-{uuid.uuid4().hex}")
    lines = counts.select(F.concat(F.col(source), F.lit(COUNT_FILE)).alias("file"), "redirs_count", count_line().alias("value"))
    lines.repartition("file").sortWithinPartitions("file", "redirs_count").select("value", "file").write.partitionBy("file").text(draft.toString())
    for entry in fs.listStatus(draft):
        if entry.isDirectory():
            name = unquote(entry.getPath().getName().removeprefix("file="))
            parts = [p.getPath() for p in fs.listStatus(entry.getPath()) if p.getPath().getName().startswith("part-")]
            if len(parts) != 1 or not fs.rename(parts[0], child(root, name)):
                raise OSError(f"{folder}/{name} could not be committed")
    fs.delete(draft, True)
    return names


def read_count_files(spark: SparkSession, folder: str) -> DataFrame:
    """S8 + S9: ``file, redirs_count, freq`` of all count files in ``folder``, by file name."""
    rows = spark.read.text(f"{folder}/*{COUNT_FILE}").select("value", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))
    parts = F.split(F.trim(F.col("value")), r"\s+", -1)
    return rows.where(F.trim("value") != "").select(F.try_url_decode("file").alias("file"), parts.getItem(0).try_cast("int").alias("redirs_count"),
                                                    F.try_element_at(parts, F.lit(2)).try_cast("bigint").alias("freq"))
