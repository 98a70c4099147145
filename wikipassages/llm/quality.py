"""Quality rules with risk-controlled cutoffs (operator 4).

Base rules are fixed numbers. The learned rules reject a document whose
feature exceeds a cutoff; a cutoff is used only if labelled good documents
show, by an exact binomial bound, that it rejects at most the allowed share
of them in its stratum. All bounds hold together with probability
1 - ``delta``: the error is split evenly over strata and rules, and within
one rule cutoffs are tested in a fixed order from the mildest on, ending at
the first that fails.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import STEP_BYTES, release, written
from wikipassages.llm.words import Words, covered, inside_windows, mix, window_hashes, words_of

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_upper"]
#: Learned rules: feature expression over COUNTS, and cutoffs from the mildest to the strictest.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / word_chars", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04]),
    "dup_lines": ("n_dup_lines / n_lines", [0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "repeats": ("n_repeat_words / n_words", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15]),
    "long_words": ("word_chars / n_words", [40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0]),
    "bangs": ("n_bangs / n_words", [1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]),
    "upper": ("n_upper / word_chars", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
}


def sums_by_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def repeated_within(keys: np.ndarray) -> np.ndarray:
    """Which entries have an equal one before or after them."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def _counts(column: pa.Array) -> pa.Table:
    w: Words = words_of(column)
    table = np.zeros((4, 256), bool)
    table[0, list(SYMBOLS)] = True
    table[1, ord("!")] = True
    table[2, 65:91] = True
    table[3] = True
    table[3, 0x80:0xC0] = False          # continuation bytes are no code points of their own
    out = {"n_words": w.counts()}
    heads = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(table[3][w.data], out=heads[1:])
    chars = np.zeros(len(w.start) + 1, np.int64)
    np.cumsum(heads[w.end] - heads[w.start], out=chars[1:])
    out["word_chars"] = chars[w.first[1:]] - chars[w.first[:-1]]
    out["n_symbols"] = sums_by_text(table[0][w.data], w.docs)
    out["n_bangs"] = sums_by_text(table[1][w.data], w.docs)
    out["n_upper"] = sums_by_text(table[2][w.data], w.docs)

    prefix = w.prefix()
    # lines with a word, hashed together with their text's number
    breaks = np.flatnonzero(w.data == 10)
    starts = np.union1d(w.docs[:-1], breaks + 1)
    starts = starts[starts < len(w.data)]
    ends = np.append(starts[1:], len(w.data))
    text_of = np.searchsorted(w.docs, starts, side="right") - 1
    closed = (ends > starts) & (w.data[np.maximum(ends - 1, 0)] == 10) if len(starts) else np.zeros(0, bool)
    ends = ends - closed
    worded = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends, text_of = starts[worded], ends[worded], text_of[worded]
    keys = mix(w.hash_ranges(prefix, starts, ends) + text_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.unique(keys, return_index=True)[1]
    lines = np.bincount(text_of, minlength=len(column))
    out["n_lines"] = lines
    out["n_dup_lines"] = lines - np.bincount(text_of[first], minlength=len(column))

    hashes = w.hash_ranges(prefix, w.start, w.end)
    inside = np.flatnonzero(inside_windows(w, 3))
    keys = window_hashes(hashes, 3)[inside] if len(inside) else np.zeros(0, np.uint64)
    keys = mix(keys + w.doc_of_word()[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out["n_repeat_words"] = sums_by_text(covered(inside[repeated_within(keys)], 3, len(w.start)), w.first)
    return pa.StructArray.from_arrays([pa.array(out[c].astype(np.int64)) for c in COUNTS], COUNTS)


def counts(text: Column) -> Column:
    """Struct of ``COUNTS`` of a string column; null and empty texts count zero everywhere.

    Lines are split at LF; a line counts as repeated if it holds a word and
    equals an earlier line of the same text. Equality is by 64-bit hashes
    within one text.
    """
    @F.arrow_udf("struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield by_steps(batch, _counts)
        release()
    return of(text)


def by_steps(column: pa.Array, f) -> pa.Array:
    """``f`` over slices of about STEP_BYTES of text, put together again."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // STEP_BYTES)) + 1
    parts = [f(column.slice(int(lo), int(hi - lo))) for lo, hi in zip([0, *cuts], [*cuts, len(column)])]
    return pa.concat_arrays(parts)


def base_failed(n_words: Column, n_repeat_words: Column, least_words: int = 50, most_repeat_percent: int = 50) -> Column:
    return (n_words < least_words) | (100 * n_repeat_words > most_repeat_percent * n_words)


def features() -> dict[str, Column]:
    """Value of each learned rule; 0 where its divisor is 0."""
    return {name: F.coalesce(F.try_divide(*[F.col(x).cast("double") for x in expr.split(" / ")]), F.lit(0.0))
            for name, (expr, _) in RULES.items()}


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), exact up to rounding.

    Summed from the edge outwards, on the side away from the mean, where terms
    fall at least as fast as a geometric series: what is left after the last
    term is below a rounding error of the sum.
    """
    if k >= n or p <= 0:
        return 1.0
    if k < 0 or p >= 1:
        return 0.0
    lower = k <= n * p
    i = k if lower else k + 1
    edge = math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    term = total = 1.0
    while i > 0 if lower else i < n:
        ratio = i * (1 - p) / ((n - i + 1) * p) if lower else (n - i) * p / ((i + 1) * (1 - p))
        term *= ratio
        total += term
        if ratio < 1 and term * ratio < 1e-17 * total * (1 - ratio):
            break
        i += -1 if lower else 1
    return min(1.0, edge * total) if lower else max(0.0, 1.0 - edge * total)


def learn_cutoffs(labelled: DataFrame, stratum: str, good: str, allowed: float = 0.01, delta: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff) that provably reject few good documents.

    ``labelled`` holds COUNTS, the stratum and a boolean ``good``; rows with a
    null label are left out, a null stratum is a stratum of its own (""). A
    stratum's rules together reject at most the share ``allowed`` of its good
    documents, with probability 1 - ``delta`` for all strata at once. Only
    counts for each stratum, rule and cutoff leave the shuffle. A stratum
    with too few good rows gets no cutoff: nothing is rejected unproven.
    """
    values = F.array(*[
        F.struct(F.lit(name).alias("rule"),
                 sum((value > c).cast("int") for c in RULES[name][1]).alias("beyond"))
        for name, value in features().items()])
    hist = labelled.where(F.col(good)).select(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.explode(values).alias("v")) \
        .groupBy("stratum", "v.rule", "v.beyond").agg(F.count("*").alias("n"))
    hist = written(hist, "quality-histogram")
    n_strata = hist.select(F.countDistinct("stratum")).first()[0]
    share, level = allowed / len(RULES), delta / (len(RULES) * max(1, n_strata))

    def chosen(part: pd.DataFrame) -> pd.DataFrame:
        rule, n = part["rule"].iloc[0], int(part["n"].sum())
        best = None
        for j, cutoff in enumerate(RULES[rule][1], 1):
            # beyond counts from the strictest cutoff on, j from the mildest
            rejected = int(part.loc[part["beyond"] > len(RULES[rule][1]) - j, "n"].sum())
            if binomial_tail(rejected, n, share) > level:
                break
            best = cutoff
        return pd.DataFrame([(part["stratum"].iloc[0], rule, best)] if best is not None else [],
                            columns=["stratum", "rule", "cutoff"])

    return hist.groupBy("stratum", "rule").applyInPandas(chosen, "stratum string, rule string, cutoff double")


def judged(df: DataFrame, stratum: str, cutoffs: DataFrame) -> DataFrame:
    """``df`` (with COUNTS) and columns base_failed, broken_rules (array) and kept; every row stays.

    ``cutoffs`` has a row for each stratum and rule at most.
    """
    by_stratum = cutoffs.groupBy(F.col("stratum").alias("__stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("__cutoffs"))
    rules = F.array(*[F.when(value > F.element_at("__cutoffs", F.lit(name)), F.lit(name)) for name, value in features().items()])
    out = df.join(by_stratum, F.coalesce(F.col(stratum).cast("string"), F.lit("")) == F.col("__stratum"), "left")
    return out.withColumns({
        "base_failed": base_failed(F.col("n_words"), F.col("n_repeat_words")),
        "broken_rules": F.array_compact(rules)}) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)).drop("__stratum", "__cutoffs")
