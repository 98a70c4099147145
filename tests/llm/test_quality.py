import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wikipassages.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    twice = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            twice |= {i, i + 1, i + 2}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(twice), lines, text.count("!"), len(re.findall("[A-Z]", text))]


def test_counts_equal_brute_force():
    r = random.Random(3)
    texts = [None, "", " ", "\n\n", "a\n\na\n a\na", "x " * 40_000]
    texts += ["".join(r.choice(["a", "b", " ", " ", "\n", "é", "#", "\x0b", " ", "c d e", "!", "B"]) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    got = quality.by_steps(pa.array(texts, pa.string()), quality._counts).to_pylist()
    for text, row in zip(texts, got):
        assert list(row.values()) == brute(text), text


def _exact_tail(k, n, p):
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.3), (3, 50, 0.05), (20, 200, 0.1), (5, 5, 0.2), (0, 4000, 0.002)])
def test_binomial_tail(k, n, p):
    assert quality.binomial_tail(k, n, p) == pytest.approx(_exact_tail(k, n, p), rel=1e-9)


@pytest.mark.parametrize("k,n,p", [(7_000, 1_000_000, 0.01 / 6), (5_000, 100_000, 0.01 / 6), (9_000, 10_000, 0.01 / 6), (6_000, 3_000_000, 0.01 / 6)])
def test_binomial_tail_far_above_the_mean(k, n, p):
    """More than 4000 terms above the mean: the sum of all of them is 1, so no such cutoff is proven."""
    assert quality.binomial_tail(k, n, p) == pytest.approx(1.0, rel=1e-9)


def test_binomial_tail_of_many_terms():
    """Against the whole sum where it is neither 0 nor 1."""
    for k, n, p in [(4_900, 3_000_000, 0.01 / 6), (5_000, 3_000_000, 0.01 / 6), (5_300, 3_000_000, 0.01 / 6), (20_000, 40_000, 0.5)]:
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        assert quality.binomial_tail(k, n, p) == pytest.approx(math.fsum(map(math.exp, logs)), rel=1e-6)


def _labelled(spark, n_good, n_loud):
    """Good rows with few symbols, a few of them with many."""
    rows = [(i, "en", 100, 500, 250 if i < n_loud else 0, True) for i in range(n_good)]
    rows += [(n_good + i, "en", 100, 500, 400, False) for i in range(50)] + [(-1, None, 100, 500, 400, True), (-2, "de", 100, 500, 400, None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, good boolean")
    for c in quality.COUNTS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(1 if c == "n_lines" else 0).cast("long"))
    return df


def test_cutoffs_keep_their_promise(spark):
    enough = _labelled(spark, 6000, 0)
    cutoffs = {(r["stratum"], r["rule"]): r["cutoff"] for r in quality.learn_cutoffs(enough, "lang", "good").collect()}
    assert cutoffs[("en", "symbols")] == min(quality.RULES["symbols"][1])
    assert not any(s == "" for s, _ in cutoffs), "one row proves nothing"
    # 30 of 6000 good rows are loud: more than the share of a rule, so no cutoff below them
    loud = {(r["stratum"], r["rule"]): r["cutoff"] for r in quality.learn_cutoffs(_labelled(spark, 6000, 30), "lang", "good").collect()}
    assert loud[("en", "symbols")] == 0.5
    few = quality.learn_cutoffs(_labelled(spark, 300, 0), "lang", "good")
    assert few.count() == 0


def test_false_rejections_stay_within_the_bound():
    """Over many draws the chosen cutoff exceeds the allowed share far less often than delta."""
    r, failures, share, level = random.Random(5), 0, 0.01, 0.05
    for _ in range(200):
        values = [r.random() for _ in range(2000)]
        best = None
        for cutoff in (0.999, 0.995, 0.99, 0.98, 0.95, 0.9):
            if quality.binomial_tail(sum(v > cutoff for v in values), 2000, share) > level:
                break
            best = cutoff
        failures += best is not None and 1 - best > share
    assert failures <= 200 * level * 2


def test_judged_nulls_repeats_and_empty(spark):
    df = _labelled(spark, 6000, 0)
    cutoffs = quality.learn_cutoffs(df, "lang", "good")
    rows = spark.createDataFrame([(1, "en", 9), (1, "en", 9), (2, None, 9), (3, "en", None), (4, "xx", 0)], "doc_id long, lang string, kept int") \
        .withColumn("text", F.when(F.col("doc_id") == 3, None).when(F.col("doc_id") == 4, "one two three " * 30)
                    .otherwise(F.concat_ws(" ", *[F.lit(f"w{i}#") for i in range(60)])))
    out = quality.judged(rows.withColumn("c", quality.counts(F.col("text"))).select("doc_id", "lang", "kept", "c.*"), "lang", cutoffs).collect()
    by_id = {r["doc_id"]: r for r in out}
    assert len(out) == 5
    assert not by_id[1]["kept"] and "symbols" in by_id[1]["broken_rules"]
    assert by_id[2]["kept"]
    assert by_id[3]["base_failed"] and not by_id[3]["kept"]
    assert by_id[4]["base_failed"]
    assert quality.judged(df.limit(0), "lang", quality.learn_cutoffs(df.limit(0), "lang", "good")).count() == 0
