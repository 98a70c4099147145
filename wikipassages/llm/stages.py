"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of ``docs``; rows that a stage does not
reject stay as they are, repeated rows and rows with null ids included
unless the stage says otherwise.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikipassages.llm import chosen_path, packing, quality, rlz, toxicity
from wikipassages.llm.common import crc_remainder, written

TOXIC_FROM = 0.3
CAPACITY = 2048


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``TOXIC_FROM`` or more go; labels of the held-out quarter are not learnt from."""
    labels = _labels(spark, sf_dir).select("doc_id", "toxic").where(crc_remainder(F.col("doc_id"), 4) != 2)
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return model.scored(docs, out="__score").where(F.col("__score") < TOXIC_FROM).select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or a cutoff of their language go; cutoffs are learnt from labelled rows of ``docs``."""
    labels = _labels(spark, sf_dir).select("doc_id", (F.col("quality") == 1).alias("good"))
    counted = docs.withColumn("__c", quality.counts(F.col("text")))
    narrow = written(counted.select("doc_id", "lang", "__c.*"), "stage-counts")
    cutoffs = quality.learn_cutoffs(narrow.join(labels, "doc_id"), "lang", "good")
    held = docs.select(F.struct(*docs.columns).alias("__doc"), "lang", quality.counts(F.col("text")).alias("__c")) \
        .select("__doc", "lang", "__c.*")
    return quality.judged(held, "lang", cutoffs).where("kept").select("__doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id (once, if its row is repeated).

    Rows of one id with different texts are different documents: all stay if their id does."""
    kept = chosen_path.near_copies(docs.select("doc_id", "text"), size=5).where("kept and doc_id is not null").select("doc_id").distinct()
    once = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(*docs.columns).union(docs.where("doc_id is null"))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document holds go from the text; untouched texts stay as they are."""
    found = rlz.parsed(docs.select("doc_id", "text", F.struct(*docs.columns).alias("__doc")))
    touched = F.col("parsed.n_removed") > 0
    fresh = {"text": F.when(touched, F.col("parsed.kept")).otherwise(F.col("__doc.text"))}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(touched, F.length("parsed.kept").cast("bigint")).otherwise(F.col("__doc.n_chars"))
    return found.select(*[fresh[c].alias(c) if c in fresh else F.col(f"__doc.{c}") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with their sequence and place in it."""
    pieces = packing.cut_pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), 0, CAPACITY, with_ids=False)
    pieces = pieces.select(F.col("doc").alias("doc_id"), "piece", "start", "length", "ids_crc32")
    return packing.packed(pieces, CAPACITY, ["doc_id", "piece", "ids_crc32"])


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_low_quality), ("near_copies", drop_near_copies),
          ("passages", cut_passages), ("best_fit", pack)]
