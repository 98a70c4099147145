"""The registered queries of the operators: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikipassages.llm import (
    bpe, brown, chosen_path, filter_audit, multi_index, packing, pii, quality, resampling, rlz, simple8b, toxicity, url_rules)
from wikipassages.llm.common import crc_remainder, shared_path, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), *vocabulary).select("doc_id", "ids")
    return ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), *vocabulary), 256).alias("decoded_sha256"))


#: Fixed by the contract: (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are labelled by the row of ``labels`` with their id: unwanted if toxic or of low quality.

    The tables have no other labels for urls, and nothing says that these hold for pages. So rules are mined from
    two thirds of the urls and used only if the labels of the last third bear them out (``url_rules.proven``).
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = table(spark, sf_dir, "labels").groupBy("doc_id") \
        .agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    labelled = pages.join(bad, pages.page_id == bad.doc_id)
    part = crc_remainder(F.col("url"), 3)
    rules = url_rules.mine(labelled.where(part != 2), "url", "bad", min_support=0.002, min_confidence=0.6)
    rules = url_rules.proven(rules, labelled.where(part == 2), "url", "bad", level=0.05)
    return url_rules.judged(pages, "url", URL_RULES, rules) \
        .select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def op3_embedding_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_copies(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", quality.counts(F.col("text")).alias("c"))
    docs = written(docs.select("doc_id", "lang", "c.*"), "quality-counts")
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good"))
    cutoffs = quality.learn_cutoffs(docs.join(labels, "doc_id"), "lang", "good")
    return quality.judged(docs, "lang", cutoffs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(crc_remainder(F.col("doc_id"), 4) != 2))
    return model.scored(docs).select("doc_id", (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                                     (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rlz.parsed(docs).select("doc_id", "parsed.n_words", "parsed.n_removed",
                                   F.sha2(F.col("parsed.kept").cast("binary"), 256).alias("kept_sha256"))


def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


CAPACITY = 2048


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                public_tokenizers.path("word_bpe_49k.json"), 0, CAPACITY, with_ids=False)
    pieces = pieces.select(F.col("doc").alias("doc_id"), "piece", "start", "length", "ids_crc32")
    return packing.packed(pieces, CAPACITY, ["doc_id", "piece", "ids_crc32"])


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "token-files")
    manifest = simple8b.write_files(table(spark, sf_dir, "documents").select("doc_id", "text"), folder,
                                    public_tokenizers.path("word_bpe_49k.json"), 2)
    return simple8b.read_files(spark, folder, manifest)


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_remainder(F.col("doc_id"), 7) == 2).alias("held_out"))
    return brown.scored(docs.withColumn("train", ~F.col("held_out")), "train") \
        .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts are those of the base rules; ``n_added`` counts the spans of the field."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.found(docs, pii.fit(docs)).select(
        "doc_id", "pii.n_email", "pii.n_ip", "pii.n_card", "pii.n_phone",
        F.sha2(pii.joined(F.col("pii.base")).cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("pii.spans")).alias("spans"), "pii.n_added")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_url_rules": op2_url_rules,
    "op3_embedding_copies": op3_embedding_copies,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_passages": op6_passages,
    "op7_near_copies": op7_near_copies,
    "op8_best_fit": op8_best_fit,
    "op9_token_files": op9_token_files,
    "op10_class_lm": op10_class_lm,
    "op11_personal_data": op11_personal_data,
    "op12_filter_audit": op12_filter_audit,
    "op13_importance_resampling": op13_importance_resampling,
}
