"""Porter stemmer word by word: the brute-force counterpart of the column expression."""
from __future__ import annotations


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in "aeiou":
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """Number of vowel-consonant sequences in ``stem``."""
    n, i, size = 0, 0, len(stem)
    while i < size and _is_cons(stem, i):
        i += 1
    while i < size:
        while i < size and not _is_cons(stem, i):
            i += 1
        if i >= size:
            break
        while i < size and _is_cons(stem, i):
            i += 1
        n += 1
    return n


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    k = len(w) - 1
    if k < 2 or not _is_cons(w, k) or _is_cons(w, k - 1) or not _is_cons(w, k - 2):
        return False
    return w[k] not in "wxy"


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


def _replace_first(w: str, rules, min_m: int) -> str:
    """Apply the first rule whose suffix matches, if the stem's measure allows."""
    for suffix, repl in rules:
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            return stem + repl if _measure(stem) > min_m else w
    return w


def _step1ab(w: str) -> str:
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
        return w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix) and _has_vowel(w[: -len(suffix)]):
            w = w[: -len(suffix)]
            if w.endswith(("at", "bl", "iz")):
                return w + "e"
            if _double_cons(w) and w[-1] not in "lsz":
                return w[:-1]
            if _measure(w) == 1 and _cvc(w):
                return w + "e"
            return w
    return w


def _step4(w: str) -> str:
    for suffix in STEP4:
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            if suffix == "ion" and not (stem and stem[-1] in "st"):
                continue
            return stem if _measure(stem) > 1 else w
    return w


def stem(word: str) -> str:
    """Porter stem of a lower-case word."""
    if len(word) <= 2:
        return word
    w = _step1ab(word)
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _replace_first(w, STEP2, 0)
    w = _replace_first(w, STEP3, 0)
    w = _step4(w)
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    if w.endswith("l") and _double_cons(w) and _measure(w) > 1:
        w = w[:-1]
    return w
