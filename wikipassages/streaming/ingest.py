"""Incremental ingestion of dump files with Structured Streaming.

The reference has no streaming. What streams naturally is the primary job's
map side: every column function and the section split are stateless, so new
dump files landing in a folder can be cut, routed, parsed and keyed as they
arrive, and appended to two tables (redirects, section texts) with
exactly-once file sinks. The join (a per-key aggregation over all data so
far) then runs as the ordinary batch step over those tables; it needs no
streaming state, watermark or late-data handling.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import redirects as R
from ..sources import dump


def stream_dump_records(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``xml`` page records of dump files as they appear in ``source_dir``."""
    reader = spark.readStream.option("lineSep", "</page>")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return dump.page_records(reader.text(source_dir))


def keyed_streams(records: DataFrame, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """(redirects ``key, page, section, redirect``; sections ``key, page_title, sec_ord, sec_text``)."""
    routed = dump.is_redirect_record()
    redirect_pages = dump.parse_pages(records.where(routed)).withColumn("is_redirect", F.lit(True))
    content_pages = dump.parse_pages(records.where(~routed)).withColumn("is_redirect", F.lit(False))
    redirects = R.section_redirects(R.wikitext_pages(redirect_pages, compat), compat)
    sections = R.section_texts(R.wikitext_pages(content_pages, compat))
    return redirects, sections


@dataclass
class Ingestion:
    redirects: StreamingQuery
    sections: StreamingQuery

    def await_termination(self) -> None:
        self.redirects.awaitTermination()
        self.sections.awaitTermination()


def start_ingestion(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                    available_now: bool = True, max_files_per_trigger: int | None = None) -> Ingestion:
    """Start two append-mode Parquet streams under ``out_dir``.

    ``checkpoint_dir`` must be on shared storage; each stream keeps its
    offsets and sink log there, so a restarted or failed job resumes without
    losing or repeating files. ``available_now`` processes what is there and
    stops; otherwise the streams keep running.
    """
    redirects, sections = keyed_streams(stream_dump_records(spark, source_dir, max_files_per_trigger))

    def start(df: DataFrame, name: str) -> StreamingQuery:
        w = (df.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{checkpoint_dir}/{name}")
             .option("path", f"{out_dir}/{name}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()

    return Ingestion(start(redirects, "redirects"), start(sections, "sections"))


def redirected_from_ingested(spark: SparkSession, out_dir: str) -> DataFrame:
    """The batch join over everything ingested so far: ``key, page, section, n, text``."""
    return R.join_redirected_sections(spark.read.parquet(f"{out_dir}/redirects"),
                                      spark.read.parquet(f"{out_dir}/sections"))
