"""Text analysis for the inverted index (Q1, Q11).

Tokens are maximal runs of letters, lower-cased; stop words are dropped but
positions keep their gaps, so phrase queries see where a stop word stood.
All of it is JVM-side work; the optional Porter stemming runs over the
*distinct* terms of a table and is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import porter

# The 33 English stop words of the classic search analyzer.
STOP_WORDS = ("a an and are as at be but by for if in into is it no not of on or such that "
              "the their then there these they this to was will with").split()

NO_LETTERS = r"\P{L}+"

# The prototype's analysis - word tokens (letters, digits,
# underscore, inner dots), its stop-word list, tokens of 2+ characters.
WORD_TOKENS = r"(?U)\w+(?:\.?\w+)*"
PROTOTYPE_STOP_WORDS = ("a an and are as at be by can for from have if in is it may not of on or tbd that "
                        "the this to us we when will with yet you your").split()
PROTOTYPE_MIN_LENGTH = 2


def analyze(text: Column | str, stop_words: list[str] | tuple[str, ...] = tuple(STOP_WORDS)) -> Column:
    """``array<struct<pos:int, term:string>>`` of a text; positions count stop words too."""
    t = F.col(text) if isinstance(text, str) else text
    # lower case and one space between runs in two native passes: a call for each token costs more
    words = F.split(F.trim(F.lower(F.regexp_replace(F.coalesce(t, F.lit("")), NO_LETTERS, " "))), " ", -1)
    tokens = F.transform(words, lambda tok, i: F.struct(i.alias("pos"), tok.alias("term")))
    return F.filter(tokens, lambda s: ~s["term"].isin("", *stop_words))     # one look into a hash set; "": a text without letters


def analyze_words(text: Column | str) -> Column:
    """Q11 tokens before stemming: word tokens, lower case, stop words and 1-char tokens dropped."""
    t = F.col(text) if isinstance(text, str) else text
    tokens = F.transform(F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(WORD_TOKENS), 0),
                         lambda tok, i: F.struct(i.alias("pos"), F.lower(tok).alias("term")))
    return F.filter(tokens, lambda s: (F.length(s["term"]) >= PROTOTYPE_MIN_LENGTH) & ~s["term"].isin(*PROTOTYPE_STOP_WORDS))


def terms(text: Column | str, stop_words=tuple(STOP_WORDS)) -> Column:
    """Just the terms of :func:`analyze`, in order."""
    return F.transform(analyze(text, stop_words), lambda s: s["term"])


def stem_terms(df: DataFrame, term_col: str = "term") -> DataFrame:
    """Replace ``term_col`` by its stem, stemming each distinct term once.

    The distinct terms are a small table (vocabulary grows far slower than
    text); they are stemmed once and joined back on the term.
    """
    vocab = df.select(term_col).distinct()
    stems = vocab.select(term_col, porter.stem(F.col(term_col)).alias("_stem"))
    return (df.join(stems, term_col, "left")
            .withColumn(term_col, F.coalesce(F.col("_stem"), F.col(term_col))).drop("_stem"))
