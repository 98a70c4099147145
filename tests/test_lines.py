"""Round trips of the line formats L1-L5 (K1-K5 writers, S5-S8 readers), K8/K9."""

import pytest
from pyspark.sql import functions as F

from wikipassages.sources import lines as L

SEP = "███"


def test_page_lines_round_trip(spark, tmp_out):
    df = spark.createDataFrame([("k1", "T1", "text one"), ("k2", "T2", "")], "key string, title string, text string")
    L.write_lines(df, L.page_line(), tmp_out + "/l1")
    back = L.parse_page_lines(L.read_lines(spark, tmp_out + "/l1"))
    # the reader keys a page by its title field; an empty text reads as ""
    assert sorted(tuple(r) for r in back.collect()) == [("T1", "T1", "text one"), ("T2", "T2", "")]


def test_redirect_group_lines_round_trip(spark, tmp_out):
    df = spark.createDataFrame([("P#S", [("R1", "t1"), ("P#S", "body")])],
                               "key string, pages array<struct<title:string,text:string>>")
    L.write_lines(df, L.redirect_group_line(), tmp_out + "/l2")
    row = L.parse_redirect_group_lines(L.read_lines(spark, tmp_out + "/l2")).first()
    assert row["key"] == "P#S" and row["n"] == 2
    assert [tuple(p) for p in row["pages"]] == [("R1", "t1"), ("P#S", "body")]


def test_redirect_group_missing_last_text_is_empty(spark):
    df = spark.createDataFrame([(f"K\t2{SEP}A{SEP}x{SEP}B{SEP}",)], "value string")
    row = L.parse_redirect_group_lines(df).first()
    assert [tuple(p) for p in row["pages"]] == [("A", "x"), ("B", "")]


def test_section_lines_round_trip_and_dead_letters(spark, tmp_out):
    df = spark.createDataFrame([("p#s", "p", "s", ["R 1", "R 2"], "body"), ("p#e", "p", "e", ["R"], "")],
                               "key string, page string, section string, redirs array<string>, text string")
    L.write_lines(df, L.section_line(), tmp_out + "/l3")
    back = L.parse_section_lines(L.read_lines(spark, tmp_out + "/l3"))
    rows = {r["section"]: r for r in back.collect()}
    assert rows["s"]["redirs"] == ["R 1", "R 2"] and rows["s"]["text"] == "body" and not rows["s"]["is_malformed"]
    # an empty text is dropped by the split: 4 parts, skipped without a dead letter
    assert "e" not in rows
    bad = spark.createDataFrame([(f"k\tp{SEP}s{SEP}x{SEP}R{SEP}t",), (f"k\tp{SEP}s{SEP}5{SEP}R{SEP}t",)], "value string")
    assert [r["is_malformed"] for r in L.parse_section_lines(bad).collect()] == [True, True]


def test_count_lines_and_partitioned_sink(spark, tmp_out):
    df = spark.createDataFrame([(1, 10, "a"), (2, 3, "a"), (1, 7, "b")], "redirs_count int, freq bigint, source_file string")
    L.write_lines(df, L.count_line(), tmp_out + "/l4", partition_by="source_file")
    back = L.read_count_lines(spark, tmp_out + "/l4/source_file=a")
    assert sorted(tuple(r) for r in back.collect()) == [(1, 10), (2, 3)]


def test_keyed_lines_sorted_parts_and_no_overwrite(spark, tmp_out):
    df = spark.createDataFrame([(f"k{i}", f"t{i}") for i in range(20)], "key string, text string")
    L.write_lines(df, L.keyed_line(), tmp_out + "/l5", num_parts=3, sort_key="key")
    files = spark.read.text(tmp_out + "/l5").select(F.input_file_name().alias("f"), "value").collect()
    by_file = {}
    for r in files:
        by_file.setdefault(r["f"], []).append(r["value"])
    assert 1 <= len(by_file) <= 3
    for vals in by_file.values():
        keys = [v.split("\t")[0] for v in vals]
        assert keys == sorted(keys)
    with pytest.raises(Exception):
        L.write_lines(df, L.keyed_line(), tmp_out + "/l5")


def test_several_files_reported_apart(spark, tmp_out):
    for name in ("a", "b"):
        spark.createDataFrame([(f"x\t{name}",)], "value string").write.text(f"{tmp_out}/{name}")
    df = L.read_lines(spark, [f"{tmp_out}/a", f"{tmp_out}/b"], with_file=True)
    assert df.select("source_file").distinct().count() == 2


def test_section_lines_with_redirs_two_phase(spark):
    red = spark.createDataFrame([("k", "p", "s", 3, "t")], "key string, page string, section string, n int, text string")
    rd = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "c")], "key string, redirect string")
    row = L.sections_with_redirs(red, rd).first()
    assert row["redirs"] == ["a", "b", "c"]


def test_keyed_lines_round_trip(spark, tmp_out):
    rows = [("P#S", " a\tb "), ("Q", ""), ("R#ž", " x ")]
    L.write_lines(spark.createDataFrame(rows, "key string, text string"), L.keyed_line(), tmp_out + "/l5")
    back = L.parse_keyed_lines(L.read_lines(spark, tmp_out + "/l5", with_file=True))
    assert back.columns == ["key", "text", "source_file"]
    assert sorted((r["key"], r["text"]) for r in back.collect()) == rows
    assert L.parse_keyed_lines(spark.createDataFrame([("alone",)], "value string")).first()["text"] == ""
