"""Corpus statistics over redirected sections.

All of these are single aggregations with partial (map-side) aggregation, so
the shuffle carries one small buffer per map task and group, whatever the
skew of the data. Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Thresholds of the reference's sanity statistics (characters).
AVG_SENTENCE_LENGTH = 85
TEST_SENTENCE_LENGTH = 10
# Word separators of the classic word-count example (Java StringTokenizer).
WORD_SEPARATORS = r"[ \t\n\r\f]+"


def indexable(sections: DataFrame, text_col: str = "text") -> DataFrame:
    """F8: sections the index takes - the ones with a non-empty text."""
    return sections.where(F.length(F.col(text_col)) > 0)


def with_counts(sections: DataFrame) -> DataFrame:
    """C17: ``char_count`` (code points) and ``redirs_count``."""
    return sections.withColumn("char_count", F.length("text")).withColumn("redirs_count", F.col("n"))


def section_stats(sections: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A5-A7 (A10 with ``by``): counts, means, arg-max sections, short-section counts.

    Ties of the arg-max pick the smallest key (a table has no line order).
    Means are null on an empty input.
    """
    df = with_counts(indexable(sections))
    length, redirs = F.col("char_count"), F.col("redirs_count")
    longest = F.min_by(F.struct("section", "page"), F.struct(-length, F.col("key")))
    most = F.min_by(F.struct("section", "page"), F.struct(-redirs, F.col("key")))
    aggs = [
        F.count(F.lit(1)).alias("sections"),
        F.avg(length).alias("avg_text_length"),
        F.avg(redirs).alias("avg_redirs"),
        F.max(length).alias("longest_length"),
        longest["section"].alias("longest_section"),
        longest["page"].alias("longest_page"),
        F.max(redirs).alias("most_redirs"),
        most["section"].alias("most_redirs_section"),
        most["page"].alias("most_redirs_page"),
        F.count_if(length < AVG_SENTENCE_LENGTH).alias("shorter_than_sentence"),
        F.count_if(length < TEST_SENTENCE_LENGTH).alias("shorter_than_test"),
        F.count_if(length == 1).alias("one_char"),
        F.count_if(length == 0).alias("zero_char"),
    ]
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(*aggs)


def redirs_count_histogram(sections: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``redirs_count, freq`` - how many sections have each number of redirects."""
    keys = list(by or []) + ["redirs_count"]
    return (with_counts(indexable(sections)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("freq")))


def weighted_histogram(counts: DataFrame, bins: int, value_col: str = "redirs_count",
                       freq_col: str = "freq") -> DataFrame:
    """A9 + C19: equal-width histogram of values weighted by ``log10(freq)``.

    ``bins`` bins over [min, max], the last one closed; a single value gets the
    range [v - 0.5, v + 0.5]. Only non-empty bins are returned:
    ``bin, bin_lo, bin_hi, n_values, weight``
    (weight rounded to 9 places). ``counts`` is one row per
    distinct value (A8), so its size is bounded by the largest count; its min
    and max are one-row scalar subqueries over a checkpointed copy.
    """
    # A8 is small (one row per distinct count) but sits on a long lineage; cut
    # it once in the shared checkpoint folder so the bounds below do not
    # re-plan and re-run the whole upstream job.
    ensure_checkpoint_dir(counts.sparkSession)
    counts = counts.checkpoint(eager=True)
    x = F.col(value_col).cast("double")
    mn = counts.select(F.min(value_col).cast("double")).scalar()
    mx = counts.select(F.max(value_col).cast("double")).scalar()
    lo = F.when(mx > mn, mn).otherwise(mn - 0.5)
    hi = F.when(mx > mn, mx).otherwise(mx + 0.5)
    n = F.lit(bins).cast("double")
    b = F.least(F.lit(bins), (F.floor((x - lo) * n / (hi - lo)) + 1).cast("int"))
    return (counts.select(b.alias("bin"), F.log10(F.col(freq_col).cast("double")).alias("w"))
            .groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n_values"), F.sum("w").alias("weight"))
            .select("bin",
                    (lo + (F.col("bin") - 1) * (hi - lo) / n).alias("bin_lo"),
                    (lo + F.col("bin") * (hi - lo) / n).alias("bin_hi"),
                    "n_values", F.round("weight", 9).alias("weight")))


def word_count(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, freq`` over whitespace-separated words (partial aggregation per task)."""
    words = F.filter(F.split(F.col(text_col), WORD_SEPARATORS, -1), lambda w: w != "")
    return (texts.select(F.explode(words).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


def log10_weight(freq: Column | str) -> Column:
    """C19."""
    return F.log10((F.col(freq) if isinstance(freq, str) else freq).cast("double"))
