"""URL filter: given (host, path) rules first, mined token rules for the rest (operator 2).

FP-growth over the tokens of labelled urls finds token combinations that go
with unwanted pages; rules below the support or confidence asked for are
pruned. Each rule is posted under its rarest token, urls meet only the rules
posted under one of their tokens, and containment is verified on the whole
token sets. Rules may be held against labels they were not mined from.
DataFrame functions only.
"""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import written

BLOCKED = "=block"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def given_rule(url_host: Column, url_path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest (verdict, host, path) rule that fits, else null.

    A rule fits its host and all subdomains if the url's path starts with its
    path. Rules are a parameter of the call, so one expression tests them.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((url_host == rule_host) | url_host.endswith("." + rule_host)) & url_path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tagged tokens: scheme, host labels, path words, query keys, fragment; empty for null."""
    text = F.coalesce(url, F.lit(""))
    low = F.lower(text)

    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    return F.array_distinct(F.concat(
        tagged("s=", F.array(F.regexp_extract(low, r"(?s)^(.*?)://", 1))),
        tagged("h=", F.split(host(url), r"\.")),
        tagged("p=", F.split(F.lower(path(url)), r"[/.]")),
        tagged("q=", F.regexp_extract_all(low, F.lit(r"[?&]([^=&#?]+)"), F.lit(1))),
        tagged("f=", F.array(F.regexp_extract(low, r"(?s)#(.*)$", 1)))))


def mine(labelled: DataFrame, url: str, unwanted: str, min_support: float, min_confidence: float,
         partitions: int | None = None) -> DataFrame:
    """Rules (antecedent array, posted, confidence, support) for unwanted urls; none from no rows.

    Tokens that stand in exactly the same rows are one item (the smallest
    stands for all): a group of copies then adds one item, not every subset
    of its tokens. Rows with a null label or without tokens are left out.
    """
    baskets = labelled.select(F.col(url).alias("url"), F.col(unwanted).alias("bad")).where("bad is not null") \
        .select(tokens(F.col("url")).alias("items"), "bad", F.xxhash64("url", F.monotonically_increasing_id()).alias("row")) \
        .where(F.size("items") > 0)
    baskets = written(baskets, "url-baskets")
    least = F.lit(min_support) * F.lit(baskets.count())
    rows = baskets.select("row", "bad", F.explode("items").alias("token"))
    kinds = rows.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.col("row").cast("decimal(38,0)")).alias("sum"),
                                      F.bit_xor("row").alias("xor")).where(F.col("n") >= least)
    kinds = written(kinds.groupBy("n", "sum", "xor").agg(F.min("token").alias("token")).select("token", "n"), "url-tokens")
    reduced = rows.join(kinds.select("token"), "token").groupBy("row").agg(F.collect_set("token").alias("items"), F.first("bad").alias("bad")) \
        .select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BLOCKED)))).otherwise(F.col("items")).alias("items"))
    spread = {} if partitions is None else {"numPartitions": partitions}
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence, **spread).fit(reduced)
    rules = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BLOCKED)) \
        .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    rules = written(rules, "url-rules-all")
    # a rule goes if leaving one token out gives a rule at least as confident: that one fits wherever it does
    wider = rules.select("antecedent", "confidence", F.explode(F.transform(
        "antecedent", lambda x: F.array_remove("antecedent", x))).alias("less"))
    kept = rules.select(F.col("antecedent").alias("less"), F.col("confidence").alias("less_confidence"))
    redundant = wider.join(kept, "less").where(F.col("less_confidence") >= F.col("confidence")).select("antecedent")
    rules = rules.join(redundant, "antecedent", "left_anti")
    rarest = rules.select("*", F.explode("antecedent").alias("token")).join(kinds, "token") \
        .groupBy("antecedent", "confidence", "support").agg(F.min(F.struct("n", "token")).alias("least"))
    return written(rarest.select("antecedent", F.col("least.token").alias("posted"), "confidence", "support"), "url-rules")


def _held_by(of_url: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows with ``items`` beside each rule whose tokens all stand in them, found by the token the rule is posted under."""
    return of_url.select("*", F.explode("items").alias("posted")).join(rules, "posted") \
        .where(F.size(F.array_except("antecedent", "items")) == 0)


def proven(rules: DataFrame, labelled: DataFrame, url: str, unwanted: str, level: float) -> DataFrame:
    """The rules whose urls in ``labelled``, rows that none of them was mined from, are surely worse than the rest.

    Each distinct url with tokens counts once, with the share of its labels that are unwanted (null
    labels are left out). A rule stays if the lower bound of its urls' mean share (Hoeffding's, valid at any
    count) is above the mean of all urls; the error ``level`` is split over all rules. A rule that no url
    holds goes, and with no labelled url all do.
    """
    held = labelled.select(F.col(url).alias("url"), F.col(unwanted).cast("double").alias("bad")).where("bad is not null and url is not null") \
        .groupBy("url").agg(F.avg("bad").alias("share"))
    held = held.select("share", tokens(F.col("url")).alias("items")).where(F.size("items") > 0)
    tests, usual = rules.count(), held.agg(F.avg("share")).first()[0]
    if not tests or usual is None:
        return rules.limit(0)
    seen = _held_by(held, rules).groupBy("antecedent").agg(F.count("*").alias("urls"), F.avg("share").alias("mean"))
    slack = F.sqrt(F.lit(math.log(tests / level)) / (2 * F.col("urls")))
    return written(rules.join(seen.where(F.col("mean") - slack > usual).select("antecedent"), "antecedent", "left_semi"), "url-rules-proven")


def matched(urls: DataFrame, url: str, rules: DataFrame) -> DataFrame:
    """Distinct urls (column ``url``) that hold a whole rule, with the most confident one (``mined``)."""
    of_url = urls.select(F.col(url).alias("url")).distinct().select("url", tokens(F.col("url")).alias("items"))
    return _held_by(of_url, rules).groupBy("url").agg(F.max(F.struct("confidence", "support", "antecedent")).alias("mined"))


def judged(pages: DataFrame, url: str, given: list[tuple[str, str, str]], rules: DataFrame) -> DataFrame:
    """``pages`` with host, path, rule, verdict and mined_rule (replacing such columns).

    The longest given rule decides; without one a url is blocked if a mined
    rule's tokens all stand in it, else allowed. Null urls: empty host and
    path, allowed. Every row is kept, repeated ones included.
    """
    mined = matched(pages, url, rules).select(F.col("url").alias("__url"), F.col("mined").alias("__mined"))
    both = pages.withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))
    both = both.join(mined, F.col(url) == F.col("__url"), "left")
    rule = given_rule(F.col("host"), F.col("path"), given)
    by_method = F.when(F.col("__mined").isNotNull(), "block").otherwise("allow")
    return both.withColumn("__given", rule).withColumns({
        "rule": F.col("__given.rule"), "verdict": F.coalesce(F.col("__given.verdict"), by_method),
        "mined_rule": F.array_join("__mined.antecedent", " ")}).drop("__given", "__url", "__mined")
