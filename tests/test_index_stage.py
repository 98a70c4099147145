"""The index stage keeps no copy of its documents, deals no text out twice and leaves no shuffle behind."""

import time

from pyspark.sql import functions as F

from wikipassages.functions.analysis import analyze
from wikipassages.operators import index as I
from wikipassages.plans import catalog
from wikipassages.session import materialize, spread

from conftest import SMALL

SECTIONS = "key string, page string, section string, n int, text string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles().iterator()
    names = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            names.add(name)
    return names


def test_a_written_stage_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = materialize(spark, "test-no-shuffle-left", lambda: spark.range(5000).withColumn("k", F.col("id") % 7).groupBy("k").agg(F.count("*").alias("n")))
    for _ in range(100):
        left = _shuffle_files(spark) - before
        if not any(name.endswith(".data") for name in left):
            break
        time.sleep(0.1)
    assert not any(name.endswith(".data") for name in left), left
    assert rows.agg(F.sum("n")).first()[0] == 5000
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"       # settings of the write are taken back


def test_bucketed_sections_are_indexed_where_they_lie(spark):
    rows = [(f"k{i % 25}", "p q", "s", 1, " ".join(f"w{j % (i + 1)}x" for j in range(i))) for i in range(40)] + [(None, "p", "s", 1, "a b b")]
    sections = spark.createDataFrame(rows, SECTIONS)
    lying = materialize(spark, "test-lying-sections", lambda: sections, bucket="key")
    found, loose = I.build_index(lying, by_key=True).postings, I.build_index(sections).postings
    assert "Exchange" not in _plan(found)
    as_set = [sorted(map(str, df.select("doc_id", "field", "term", "len", "tf", "positions").collect())) for df in (found, loose)]
    assert as_set[0] and as_set[0] == as_set[1]


def test_the_registered_index_writes_no_second_copy_of_the_texts(spark):
    ix = catalog.section_index(spark, SMALL)
    files = {f.rsplit("/", 2)[-2] for f in ix.docs.inputFiles()}
    assert files and all("redirected" in f for f in files), files
    assert ix.docs.columns == ["doc_id", "key", "page", "section", "text", "redirs_count", "char_count"]


def test_any_number_of_repeated_terms_is_grouped_alike(spark):
    few = " ".join(["a b a c"] * 3 + ["d"])
    many = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(I.FEW_REPEATED + 9)) + " once "
    rows = spark.createDataFrame([(t,) for t in ("x", few, many + many, many, "", None, "Éa éA", "1 2")], "text string")
    toks = analyze(F.col("text"))
    for r in rows.select("text", F.sort_array(I._grouped(toks)).alias("a"), F.sort_array(F.when(F.size(toks) > 0, I._sorted_runs(toks))).alias("b")).collect():
        assert r["a"] == r["b"], r["text"]


def test_an_input_of_many_files_is_not_dealt_out(spark, tmp_out):
    spark.range(100).repartition(8).write.parquet(f"{tmp_out}/many")
    spark.range(100).coalesce(1).write.parquet(f"{tmp_out}/one")
    assert "Exchange" not in _plan(spread(spark.read.parquet(f"{tmp_out}/many"), 4))
    assert "Exchange" in _plan(spread(spark.read.parquet(f"{tmp_out}/one"), 4))
