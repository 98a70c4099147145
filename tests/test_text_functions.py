"""Pinned cases for the column functions (C1-C7, C15), incl. the quirk ledger."""

import pytest
from pyspark.sql import functions as F

from wikipassages.functions import text as T


def one(spark, col_fn, value):
    df = spark.createDataFrame([(value,)], "s string")
    return df.select(col_fn(F.col("s")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("Foo_bar-baz<ref>x</ref>", "Foo bar–baz"),
    ("'''B'''", "B"),                       # bold first: no quote left (ledger 4, fixed)
    ("''i''", "i"),
    ("a<!-- c -->b", "ab"),
    ("x{{cn}}", "x"),
    ("<S>s</s><u>u</U>", "su"),
    ("  a b\t", "a b"),
    ("a\u0007b", "ab"),
    ("[[X|y]] z", "y z"),
])
def test_strip_title(spark, raw, expected):
    assert one(spark, T.strip_title, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("a [[X|y|z]] b", "a y b"),
    ("[[X]]", "X"),
    ("[[X#s]]", "[[X#s]]"),
    ("[[ X ]]", "X"),
    ("[[x|]]", "x|"),                        # a trailing pipe alone does not count
    ("[[|x]]", "x"),
    ("no links", "no links"),
])
def test_extract_references(spark, raw, expected):
    assert one(spark, T.extract_references, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("Caf%C3%A9", "Café"),
    ("Caf.C3.A9", "Café"),
    ("facade", "facade"),
    ("%C5%BF", "ſ"),                         # ledger 1, fixed
    ("x+12y", "x+12y"),                      # ledger 2, fixed
    ("Area.51", "AreaQ"),                    # ledger 3, kept
])
def test_decode_title(spark, raw, expected):
    assert one(spark, T.decode_title, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("%C5%BF", "�%BF"),
    ("x+12y", "x 12y"),
    ("Caf%C3%A9", "Café"),
])
def test_decode_title_compat(spark, raw, expected):
    assert one(spark, lambda c: T.decode_title(c, compat=True), raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("P#{{Anchor|a|b}}T", ["P#a", "P#b"]),
    ("P#{{kotva|a}}", ["P#a"]),
    ("P#T", ["P#T"]),
    ("{{anchor|a|b}}", ["a", "b"]),
    ("P#{{anchor|a||}}", ["P#a"]),
    ("P#{{anchor||}}", []),
    ("P#{{anchor|a}} {{anchor|b}}", ["P#a"]),  # first template only
])
def test_extract_anchors(spark, raw, expected):
    assert one(spark, T.extract_anchors, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("#REDIRECT [[P#S]]", "P#S"),
    ("#redirect[[P#S]] tail", "P#S"),
    ("  #Redirect [[P#S]]", "P#S"),
    ("#presmeruj [[P#S]]", "P#S"),
    ("text #PRESMERUJ [[P#S]]", "P#S"),      # ledger 6, kept: found anywhere
    ("text #redirect [[P#S]]", ""),          # "#redirect" only at the start
    ("#REDIRECT [[P]]", ""),
    ("#REDIRECT [[#S]]", ""),
    ("#REDIRECT [[Foo]] {{R}} [[Bar#Baz]]", ""),   # ledger 5, fixed
])
def test_redirect_section_target(spark, raw, expected):
    assert one(spark, T.redirect_section_target, raw) == expected


def test_redirect_target_compat_runs_over_brackets(spark):
    got = one(spark, lambda c: T.redirect_section_target(c, compat=True), "#REDIRECT [[Foo]] {{R}} [[Bar#Baz]]")
    assert got == "Foo]] {{R}} [[Bar#Baz"


@pytest.mark.parametrize("raw,expected", [
    ("#REDIRECT [[P # S]]", ["P#S"]),
    ("#presmeruj [[P#S]]", ["P#S"]),
    ("#presmeruj [[P#S]] x", []),
    ("#REDIRECT [[P<#S]]", []),
    ("#REDIRECT [[P]]", []),
])
def test_staged_redirect_targets(spark, raw, expected):
    assert one(spark, T.staged_redirect_targets, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("{{Main|A|B}}", ["A|B"]),
    ("{{main|A}}", []),
    ("x {{Main|A}} y {{Hlavný článok|B}}", ["A}} y {{Hlavný článok|B"]),   # greedy to the last }} of the line
    ("{{Main|A}}\n{{Hlavný článok|B}}", ["A", "B"]),
])
def test_main_article_links(spark, raw, expected):
    assert one(spark, T.main_article_links, raw) == expected


@pytest.mark.parametrize("key,expected", [
    ("p#s", (True, "p", "s")),
    ("p#", (False, None, None)),
    ("p#a#b", (True, "p", "a")),
    ("p##b", (True, "p", "")),
    ("#s", (True, "", "s")),
    ("p", (False, None, None)),
])
def test_split_section_key(spark, key, expected):
    df = spark.createDataFrame([(key,)], "key string")
    valid, page, section = T.split_section_key("key")
    row = df.select(valid.alias("v"), F.when(valid, page).alias("p"), F.when(valid, section).alias("s")).first()
    assert (row["v"], row["p"], row["s"]) == expected


def test_tab_terminated(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "a array<string>")
    assert [r[0] for r in df.select(T.tab_terminated("a")).collect()] == ["a\tb\t", ""]
