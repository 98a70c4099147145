"""Group lines written piece by piece: byte-equal to the lines built from lists, hot keys, lost tasks, bad inputs."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wikipassages.operators import sections as S
from wikipassages.plans import staged
from wikipassages.sources import groups, lines as L

SEP = "███"


def _lines(spark, folder):
    return sorted(r["value"] for r in L.read_lines(spark, folder).collect())


def test_section_lines_equal_the_list_form(spark, tmp_out):
    heads = spark.createDataFrame([("p#s", "p", "s", "body"), ("p#e", "p", "e", ""), ("q#x", "q", "x", None), ("r#y", "r", "y", "žluť 𝒳")],
                                  "key string, page string, section string, text string")
    redirects = spark.createDataFrame([("p#s", "B"), ("p#s", "A"), ("p#s", "A"), ("p#e", "R"), ("r#y", "č"), ("gone#z", "G"), ("p#s", None)],
                                      "key string, redirect string")
    groups.write_sections(heads, redirects, tmp_out + "/l3", num_parts=3)
    assert _lines(spark, tmp_out + "/l3") == sorted([
        f"p#s\tp{SEP}s{SEP}4{SEP}{SEP}A{SEP}A{SEP}B{SEP}body", f"p#e\tp{SEP}e{SEP}1{SEP}R{SEP}",
        f"q#x\tq{SEP}x{SEP}0{SEP}", f"r#y\tr{SEP}y{SEP}1{SEP}č{SEP}žluť 𝒳"])


def test_given_counts_spare_the_joins(spark, tmp_out):
    heads = spark.createDataFrame([("p#s", "p", "s", 2, "body"), ("q#x", "q", "x", 0, "t")], "key string, page string, section string, n int, text string")
    redirects = spark.createDataFrame([("p#s", "B"), ("p#s", "A")], "key string, redirect string")
    groups.write_sections(heads, redirects, tmp_out + "/given")
    assert _lines(spark, tmp_out + "/given") == [f"p#s\tp{SEP}s{SEP}2{SEP}A{SEP}B{SEP}body", f"q#x\tq{SEP}x{SEP}0{SEP}t"]


def test_redirect_groups_equal_the_list_form(spark, tmp_out):
    sections = spark.createDataFrame([("D#A", "D#A", "body"), ("R1", "R1", "#REDIRECT [[D#A]]"), ("R2", "R2", "#REDIRECT [[D#A]]"), ("Lone", "Lone", "x")],
                                     "key string, title string, text string")
    groups.write_redirect_groups(S.explode_redirect_targets(sections), tmp_out + "/new")
    L.write_lines(staged.redirect_groups(sections), L.redirect_group_line(), tmp_out + "/old")
    assert _lines(spark, tmp_out + "/new") == _lines(spark, tmp_out + "/old") and len(_lines(spark, tmp_out + "/new")) == 2


def test_hot_key_streams_through_in_small_batches(spark, tmp_out):
    n = 60_000
    redirects = spark.range(3 * n).select(F.when(F.col("id") % 3 == 0, "hub#s").otherwise(F.concat(F.lit("p#"), F.col("id"))).alias("key"),
                                          F.format_string("title %09d", "id").alias("redirect"))
    heads = redirects.select("key").distinct().select("key", F.lit("p").alias("page"), F.lit("s").alias("section"), F.lit("t").alias("text"))
    groups.write_sections(heads, redirects, tmp_out + "/hot", num_parts=4)
    read = L.parse_section_lines(L.read_lines(spark, tmp_out + "/hot"))
    assert read.count() == 2 * n + 1 and read.where("is_malformed").count() == 0
    hub = read.where("key = 'hub#s'").first()
    assert hub["n"] == n and hub["redirs"] == [f"title {i:09d}" for i in range(0, 3 * n, 3)] and hub["text"] == "t"
    assert len([f for f in os.listdir(tmp_out + "/hot") if f.startswith("part-")]) == 4


def test_writer_appends_bytes_and_names_files_only_at_commit(spark, tmp_out, monkeypatch):
    class Context:
        def partitionId(self):
            return 3
    monkeypatch.setattr(groups.TaskContext, "get", classmethod(lambda cls: Context()))
    uri = "file://" + tmp_out + "/direct"
    writer = groups.PieceWriter(uri, "job")

    def batches(*pieces):
        return iter([pa.RecordBatch.from_arrays([pa.array([p])], ["piece"]) for p in pieces])
    lost = writer.write(batches("half a li"))                       # an attempt that never reported
    done = writer.write(batches("k\t1", SEP + "a", "", SEP + "č\n"))
    empty = writer.write(batches())
    assert lost.draft != done.draft and not [f for f in os.listdir(tmp_out + "/direct") if not f.startswith("_")]
    writer.commit([done, empty, None])
    assert sorted(os.listdir(tmp_out + "/direct")) == ["_SUCCESS", "part-00003.txt"]
    with open(tmp_out + "/direct/part-00003.txt", encoding="utf-8") as f:
        assert f.read() == f"k\t1{SEP}a{SEP}č\n"
    other = groups.PieceWriter(uri, "other")
    other.write(batches("x"))
    other.abort([])
    other.abort([])
    assert sorted(os.listdir(tmp_out + "/direct")) == ["_SUCCESS", "part-00003.txt"]


def test_existing_output_and_failed_job_leave_no_files(spark, tmp_out):
    heads = spark.createDataFrame([("k", "k\t", "")], "key string, head string, end string")
    members = spark.createDataFrame([("k", "a", "a")], "key string, order string, piece string")
    groups.write_group_lines(heads, members, tmp_out + "/once")
    with pytest.raises(FileExistsError):
        groups.write_group_lines(heads, members, tmp_out + "/once")
    bad = members.withColumn("piece", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        groups.write_group_lines(heads, bad, tmp_out + "/bad")
    assert not os.path.exists(tmp_out + "/bad") or os.listdir(tmp_out + "/bad") == []


def test_empty_tables(spark, tmp_out):
    heads = spark.createDataFrame([], "key string, page string, section string, text string")
    groups.write_sections(heads, spark.createDataFrame([("k", "r")], "key string, redirect string"), tmp_out + "/none")
    assert _lines(spark, tmp_out + "/none") == []
