"""Broken records and bad lines are counted by the job that reads them."""

import pytest
from pyspark.sql import Observation

from wikipassages.plans.primary import run_primary_records
from wikipassages.sources import dump, lines

from test_parse_once import RECORDS

BROKEN_REDIRECT = '<page><title>B</title><redirect title="A" /><revision><text>open</page>'


@pytest.mark.parametrize("suffix, options", [("xml", {}), ("xml.bz2", {"compression": "bzip2"})])
def test_primary_counts_what_it_skips(spark, tmp_path, suffix, options):
    path = str(tmp_path / f"dump.{suffix}")
    rows = ["<mediawiki><siteinfo/>"] + RECORDS + [BROKEN_REDIRECT] + ["</mediawiki>"]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.options(**options).text(path)
    content, redirects = Observation(), Observation()
    job = run_primary_records(dump.read_dump_records(spark, path), seen=(content, redirects))
    plain = run_primary_records(dump.read_dump_records(spark, path))
    assert sorted(job.redirected.collect()) == sorted(plain.redirected.collect())
    assert content.get == {"records": 3, "broken": 1}
    assert redirects.get == {"records": 3, "broken": 1}


def test_no_record_is_counted_as_none(spark):
    seen = Observation()
    assert dump.parse_pages(spark.createDataFrame([], "xml string"), seen=seen).collect() == []
    assert seen.get == {"records": 0, "broken": 0}


def test_bad_lines(spark):
    good = "k\tpage█s█1█from█text"
    bad = ["k\tpage█s█x█from█text", "short", good + "█more"]
    df = spark.createDataFrame([(line.replace("█", "███"),) for line in [good, *bad]], "value string")
    seen = Observation()
    rows = lines.parse_section_lines(df, seen).collect()
    assert seen.get == {"lines": 3, "malformed": 2} and [r["is_malformed"] for r in rows] == [False, True, True]
