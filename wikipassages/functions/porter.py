"""Porter stemmer (M. F. Porter, "An algorithm for suffix stripping", 1980) as column expressions.

A ``y`` that is a consonant is written ``Y`` for the whole run, so that vowels
are ``[aeiouy]`` and consonants everything else, and every condition of the
algorithm is a regular expression on the stem. Follows the author's reference
implementation, including its two departures from the paper (``bli`` ->
``ble`` and ``logi`` -> ``log`` in step 2).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Suffix rules of the algorithm, in the order they are tried.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
         ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
         ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
         ("logi", "log")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
         ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
         "ou", "ism", "ate", "iti", "ous", "ive", "ize"]

# Conditions on a stem.
HAS_VOWEL = "[aeiouy]"
MEASURE_OVER_0 = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
MEASURE_OVER_1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]"
MEASURE_1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]*$"
ENDS_CVC = "[^aeiouy][aeiouy][^aeiouywxY]$"
# Consonantal y, in the order the rewrites apply.
CONSONANT_Y = [("^y", "Y"), ("([aeiou])y", "$1Y"), ("yy", "yY")]


def _cut(w: Column, n: int) -> Column:
    return F.substr(w, F.lit(1), F.length(w) - n)


def _doubled(w: Column) -> Column:
    """Ends in the same consonant twice."""
    return (F.length(w) >= 2) & (F.lower(F.right(w, F.lit(1))) == F.lower(F.substring(w, -2, 1))) & w.rlike("[^aeiouy]$")


def _first_rule(w: Column, rules: list[tuple[str, str]], condition: Callable[[Column], Column]) -> Column:
    """The first rule whose suffix is there, if its stem meets the condition."""
    out = w
    for suffix, new in reversed(rules):
        stem = _cut(w, len(suffix))
        out = F.when(w.endswith(suffix), F.when(condition(stem), F.concat(stem, F.lit(new))).otherwise(w)).otherwise(out)
    return out


def _plural(w: Column) -> Column:
    return F.when(w.endswith("sses") | w.endswith("ies"), _cut(w, 2)) \
        .when(w.endswith("ss") | ~w.endswith("s"), w).otherwise(_cut(w, 1))


def _after_ed_ing(w: Column) -> Column:
    return F.when(w.endswith("at") | w.endswith("bl") | w.endswith("iz"), F.concat(w, F.lit("e"))) \
        .when(_doubled(w) & ~w.rlike("[lsz]$"), _cut(w, 1)) \
        .when(w.rlike(MEASURE_1) & w.rlike(ENDS_CVC), F.concat(w, F.lit("e"))).otherwise(w)


def _ed_ing(w: Column) -> Column:
    out = w
    for suffix in ("ing", "ed"):
        stem = _cut(w, len(suffix))
        out = F.when(w.endswith(suffix) & stem.rlike(HAS_VOWEL), let(stem, _after_ed_ing)).otherwise(out)
    return F.when(w.endswith("eed"), F.when(_cut(w, 3).rlike(MEASURE_OVER_0), _cut(w, 1)).otherwise(w)).otherwise(out)


def _final_y(w: Column) -> Column:
    return F.when(w.rlike("[yY]$") & _cut(w, 1).rlike(HAS_VOWEL), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _step4(w: Column) -> Column:
    out = w
    for suffix in reversed(STEP4):
        stem = _cut(w, len(suffix))
        fits = w.endswith(suffix) & (stem.rlike("[st]$") if suffix == "ion" else F.lit(True))
        out = F.when(fits, F.when(stem.rlike(MEASURE_OVER_1), stem).otherwise(w)).otherwise(out)
    return out


def _final_e(w: Column) -> Column:
    stem = _cut(w, 1)
    drops = stem.rlike(MEASURE_OVER_1) | (stem.rlike(MEASURE_1) & ~stem.rlike(ENDS_CVC))
    return F.when(w.endswith("e") & drops, stem).otherwise(w)


def _final_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(MEASURE_OVER_1), _cut(w, 1)).otherwise(w)


def stem(word: Column) -> Column:
    """Porter stem of a lower-case word; null stays null, words of one or two letters stay as they are."""
    marked = word
    for pattern, new in CONSONANT_Y:
        marked = F.regexp_replace(marked, pattern, new)
    out = marked
    for step in (_plural, _ed_ing, _final_y, lambda w: _first_rule(w, STEP2, lambda s: s.rlike(MEASURE_OVER_0)),
                 lambda w: _first_rule(w, STEP3, lambda s: s.rlike(MEASURE_OVER_0)), _step4, _final_e, _final_l):
        out = let(out, step)
    return F.when(F.length(word) <= 2, word).otherwise(F.translate(out, "Y", "y"))
