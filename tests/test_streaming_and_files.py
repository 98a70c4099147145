"""The corpus written as dump files: batch file scan and streaming ingestion both give the flagship."""

from wikipassages.plans import corpus
from wikipassages.plans.primary import run_primary_records
from wikipassages.sources import dump
from wikipassages.streaming import ingest

from conftest import SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dump_files_batch_and_stream(spark, tmp_path):
    src = str(tmp_path / "dumps")
    # two "dump files": the corpus records split in two text outputs
    recs = corpus.corpus_xml(spark, SMALL)
    recs.repartition(2).write.text(src)
    expected = _rows(run_primary_records(recs).redirected)

    from_files = _rows(run_primary_records(dump.read_dump_records(spark, src)).redirected)
    assert from_files == expected

    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    ingest.start_ingestion(spark, src, out, ckpt).await_termination()
    assert _rows(ingest.redirected_from_ingested(spark, out)) == expected


def test_bz2_dump_file_gives_the_flagship(spark, tmp_path):
    src = str(tmp_path / "bz2dump")
    recs = corpus.corpus_xml(spark, SMALL)
    recs.coalesce(1).write.option("compression", "bzip2").text(src)
    import glob
    assert glob.glob(src + "/*.bz2")
    expected = _rows(run_primary_records(recs).redirected)
    assert _rows(run_primary_records(dump.read_dump_records(spark, src)).redirected) == expected


def test_dump_scan_splits_without_losing_pages(spark, tmp_path):
    recs = corpus.corpus_xml(spark, SMALL)
    n_pages = recs.count()
    for codec in ("none", "bzip2"):
        src = str(tmp_path / f"split-{codec}")
        recs.coalesce(1).write.option("compression", codec).text(src)
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
        try:
            got = dump.read_dump_records(spark, src)
            assert got.rdd.getNumPartitions() > 1
            assert got.count() == n_pages
            assert got.distinct().count() == n_pages
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
