"""What must not grow with the square of a group, or with a folder for each page, and what the faster forms must keep."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from wikipassages.functions import text as T
from wikipassages.operators import index
from wikipassages.operators import sections as S
from wikipassages.plans import catalog, staged
from wikipassages.sources import lines


def test_a_group_line_is_split_once(spark, tmp_out):
    """each member looked into a split of its own of the whole line (12,000 members: minutes)."""
    n = 12_000
    line = f"P#S\t{n + 1}███P#S███own" + "".join(f"███member {i}███{'text ' * 8}{i}" for i in range(n))
    with open(f"{tmp_out}/lines.txt", "w") as f:
        f.write(line + "\n")
    begun = time.monotonic()
    groups = lines.parse_redirect_group_lines(lines.read_lines(spark, f"{tmp_out}/lines.txt"))
    assert [tuple(r) for r in staged.redirected_groups(groups).collect()] == [("P#S", "own")]
    assert groups.select(F.size("pages")).first()[0] == n + 1
    assert time.monotonic() - begun < 20
    for read in (lines.parse_redirect_group_lines, lines.parse_section_lines, lines.parse_page_lines):
        plan = read(lines.read_lines(spark, f"{tmp_out}/lines.txt")).where("key is not null")._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"split\(regexp_replace\(value", plan)) == 1, plan


def test_pages_without_a_language_share_a_folder(spark, tmp_out):
    """each of them had a folder."""
    rows = [("doc 1–en#s", "doc 1–en", "s", 1, "a b"), ("doc 2–sk#s", "doc 2–sk", "s", 1, "c")] + [
        (f"css {i}#s", f"css {i}", "s", 1, "x" if i % 2 else "") for i in range(6)]
    redirected = spark.createDataFrame(rows, "key string, page string, section string, n int, text string")
    redirects = redirected.select("key", "page", "section", F.concat(F.lit("r "), "page").alias("redirect"))
    read = catalog.section_line_files(redirected, redirects, f"{tmp_out}/sections")
    assert {(r["key"], r["n"], r["text"], r["source"]) for r in read.collect()} == {
        ("doc 1–en#s", 1, "a b", "en"), ("doc 2–sk#s", 1, "c", "sk"), *((f"css {i}#s", 1, "x", f"css {i}") for i in (1, 3, 5))}
    assert sum(name.startswith("source=") for name in os.listdir(f"{tmp_out}/sections")) == 3


OLD_HEADING = r"[^=;]==\ ?([^=;]+)\ ?==(?![=;])|^==\ ?([^=;]+)\ ?==(?![=;])"
TEXTS = ["", " ", "no heading", "== a ==x", "x== a ==y", "x==a==y== b  ==z", "== ==x", "x=== c === y", "x== d ==; y", "x;== e == y", "== f ==== g == h",
         "x==h;i== j", "a\n== k == l", "x== a ==\n== b ==y", "=", "x==", "x== a == b == c == d ==", None]


def test_flat_sections_as_by_the_two_part_pattern(spark):
    pages = spark.createDataFrame([(f"k{i}", f"t {i}", t) for i, t in enumerate(TEXTS)], "key string, title string, text string")
    found = {(r["key"], r["text"], r["sec_ord"]) for r in S.flat_sections(pages).collect()}
    expected = set()
    for i, t in enumerate(TEXTS):
        heads = list(re.finditer(OLD_HEADING, t or ""))
        ends = [m.start() for m in heads[1:]] + [len(t or "")]
        for k, (m, end) in enumerate(zip(heads, ends)):
            expected.add((re.sub(r"\s", "", f"t {i}#{m[1] or m[2]}"), t[m.end():end], k))
        if not heads:
            expected.add((f"k{i}", t, 0))
    assert found == expected
    redirect = ["#redirect [[A b#C d]]", " #REDIRECT  [[A#B]] x", "x #presmeruj [[A#B]]", "#presmeruj [[A#B]] x", "[[A#B]]", "#redirect [[A]]", "", None]
    rows = spark.createDataFrame([(t,) for t in redirect], "text string").select("text", T.trimmed_redirect_targets("text")).collect()
    assert [r[1] for r in rows] == [["Ab#Cd"], ["A#B"], ["A#B"], [], [], [], [], None]


@pytest.mark.parametrize("title", ["Plain Title", "a-b_c d", "_a", "a_", " a", "a ", "a\t", "'''b''' x", "''i''", "[[a|b]]", "<s>x</s>", "x{{cn}}",
                                   "a\x07b", "  a", "a  ", "a#b", "", "é–x", "x'_", None])
def test_titles_without_markup_take_the_short_way_to_the_same(spark, title):
    row = spark.createDataFrame([(title,)], "t string").select(T.strip_title("t"), T._strip_markup(F.col("t"))).first()
    assert row[0] == row[1]


def test_postings_are_grouped_inside_documents(spark):
    """Token rows were sorted with their keys to be grouped; keys may repeat or be null."""
    rows = [("a", "x y x"), ("a", "y z y"), ("a", "x"), ("b", ""), ("b", None), (None, "x x"), (None, "y x")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    ix = index.build_field_index(docs, {"sectionText": "text"})
    got = {(r["doc_id"], r["term"], r["len"]): (r["tf"], list(r["positions"])) for r in ix.postings.collect()}
    assert got == {("a", "x", 3): (2, [0, 2]), ("a", "y", 3): (3, [0, 1, 2]), ("a", "z", 3): (1, [1]), ("a", "x", 1): (1, [0]),
                   (None, "x", 2): (3, [0, 1, 1]), (None, "y", 2): (1, [0])}
    plan = ix.postings._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[[^\]]*term", plan), plan
