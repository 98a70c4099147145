"""Toxicity scores: boosted trees over dense features, calibrated (operator 5).

Labelled rows are split three ways by their hash: one part gives the
lexicon (words and word beginnings that occur in toxic texts far more often
than in others), one the boosted trees, one the isotonic calibration, so no
step sees its own training rows as evidence. The features: lexicon
densities, lexicon words near a second person, capitals, punctuation,
digits, and obfuscation (letters mixed with digits or marks, and lexicon
words that only appear once such disguise is undone).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import frugal, release, text_slices, written
from wikipassages.llm.quality import by_steps, sums_by_text
from wikipassages.llm.words import Words, mix, text_bytes, words_from

# Insults and second-person words that count whatever the labels hold.
INSULTS = ["idiot", "stupid", "moron", "loser", "trash", "scum", "pathetic", "worthless", "disgusting", "clown", "dumb",
           "fool", "jerk", "bastard", "dumm", "dummkopf", "arschloch", "abschaum", "imbécile", "crétin", "ordure",
           "connard", "estúpido", "imbécil", "basura", "tonto"]
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu",
                 "te", "toi", "ton", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes", "vosotros"]
#: Bytes of the word beginnings that the lexicon may hold, besides whole words.
BEGINNINGS = (4, 5, 6)
#: Letters that digits and marks stand for in disguised words.
DISGUISE = dict(zip(b"013457@$", b"oieastas"))
NAMES = ["lexicon", "log_hits", "weight", "near_second_person", "second_person", "capitals", "capital_words", "exclamations",
         "punctuation", "digits", "mixed_words", "disguised", "log_words", "stretched", "insults"]

_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_SEPARATORS = b" \t\n\x0b\x0c\r" + _MARKS


def _plain_words(data: np.ndarray, docs: np.ndarray) -> Words:
    return words_from(data, docs, _SEPARATORS)


def _undisguised(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digits and marks inside words read as letters, single marks between letters left out."""
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    beside = np.zeros(len(data), bool)
    beside[1:-1] = letter[:-2] & letter[2:]
    table = np.arange(256, dtype=np.uint8)
    for mark, stands_for in DISGUISE.items():
        table[mark] = stands_for
    touches = np.zeros(len(data), bool)
    touches[1:] |= letter[:-1]
    touches[:-1] |= letter[1:]
    read = np.where(touches, table[data], data)
    drop = beside & np.isin(data, list(b".*-_~"))
    drop[docs[:-1][docs[:-1] < len(data)]] = False
    kept = np.append(0, np.cumsum(~drop))
    return read[~drop], kept[docs]


def _terms(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word number, hash) of whole words, then of each length of beginning."""
    prefix = w.prefix(seed=3)
    out = [(np.arange(len(w.start)), w.hash_ranges(prefix, w.start, w.end))]
    for size in BEGINNINGS:
        longer = np.flatnonzero(w.end - w.start > size)
        out.append((longer, mix(w.hash_ranges(prefix, w.start[longer], w.start[longer] + size) ^ np.uint64(size))))
    return out


def _listed(words: list[str]) -> np.ndarray:
    column = pa.array(words)
    w = _plain_words(*text_bytes(column))
    return np.sort(w.hash_ranges(w.prefix(seed=3), w.start, w.end))


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted ``known``, or -1."""
    if not len(known):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def _features(column: pa.Array, lexicon: np.ndarray, weights: np.ndarray) -> pa.Array:
    data, docs = text_bytes(column)
    low, low_docs = text_bytes(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    w = _plain_words(low, low_docs)
    n = w.counts()

    def hits(view: Words) -> np.ndarray:
        weight = np.zeros(len(view.start))
        for at, hashes in _terms(view):
            place = _among(hashes, lexicon)
            found = place >= 0
            weight[at[found]] = np.maximum(weight[at[found]], weights[place[found]])
        return weight

    weight = hits(w)
    hit = weight > 0
    whole = w.hash_ranges(w.prefix(seed=3), w.start, w.end)
    second = _among(whole, _listed(SECOND_PERSON)) >= 0
    reach = np.append(0, np.cumsum(second))
    index, text_of = np.arange(len(hit)), w.doc_of_word()
    lo, hi = np.maximum(index - 5, w.first[text_of]), np.minimum(index + 6, w.first[text_of + 1])
    near = hit & (reach[hi] > reach[lo])
    shown = _plain_words(*_undisguised(low, low_docs))
    shown_hits = sums_by_text(hits(shown) > 0, shown.first)
    plain_hits = sums_by_text(hit, w.first)

    kinds = np.zeros((4, 256), bool)
    kinds[0, 65:91] = True                                   # capitals
    kinds[1, 65:91], kinds[1, 97:123] = True, True           # letters
    kinds[2, list(_MARKS)] = True
    kinds[3, 48:58] = True
    count = [sums_by_text(k[data], docs) for k in kinds]
    bangs = sums_by_text(data == ord("!"), docs)
    raw = words_from(data, docs)
    inner = [np.append(0, np.cumsum(k[data])) for k in kinds]
    capital, letters, marks, digits = [x[raw.end] - x[raw.start] for x in inner]
    shouted = sums_by_text((letters >= 3) & (capital == letters), raw.first)
    ends = np.array([0], np.int64) if not len(raw.end) else raw.end - 1
    inside_marks = marks - (kinds[2][data[ends]] if len(raw.end) else 0)
    mixed = sums_by_text((letters > 0) & ((digits > 0) | (inside_marks > 0)), raw.first)
    same = np.zeros(len(data), bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & kinds[1][data[2:]]
    words, chars = np.maximum(n, 1), np.maximum(np.diff(docs), 1)
    total = np.append(0, np.cumsum(weight))
    table = np.stack([
        plain_hits / words, np.log1p(plain_hits), (total[w.first[1:]] - total[w.first[:-1]]) / words,
        sums_by_text(near, w.first) / words, sums_by_text(second, w.first) / words,
        count[0] / np.maximum(count[1], 1), shouted / words, bangs / words, count[2] / chars, count[3] / chars,
        mixed / words, np.maximum(shown_hits - plain_hits, 0) / words, np.log1p(n), sums_by_text(same, docs) / chars,
        sums_by_text(_among(whole, _listed(INSULTS)) >= 0, w.first) / words], axis=1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * len(NAMES)), pa.array(table.reshape(-1)))


def features(text: Column, lexicon: np.ndarray, weights: np.ndarray) -> Column:
    """Array of the features ``NAMES``; null and empty texts have zeros."""
    @F.arrow_udf("array<double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield by_steps(batch, lambda part: _features(part, lexicon, weights))
        release()
    return of(text)


def learn_lexicon(rows: DataFrame, least_texts: int = 3, least_ratio: float = 20.0, most_terms: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """Terms of toxic texts from rows (text, toxic), equal texts counting once: sorted hashes and log ratios.

    The lexicon is a part of the model, so its size is a parameter.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            low, docs = text_bytes(pc.utf8_lower(pc.fill_null(part.column("text").cast(pa.large_string()), "")))
            w = _plain_words(low, docs)
            text_of, found = w.doc_of_word(), []
            for at, hashes in _terms(w):
                pairs = np.unique(np.stack([hashes, text_of[at].astype(np.uint64)]), axis=1)
                found.append(pairs)
            pairs = np.concatenate(found, axis=1)
            toxic = part.column("toxic").to_numpy()[pairs[1].astype(np.int64)]
            terms, inverse = np.unique(pairs[0], return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(np.bincount(inverse, toxic, len(terms)).astype(np.int64)),
                                              pa.array(np.bincount(inverse, minlength=len(terms)))], ["term", "toxic", "n"])

    once = rows.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = once.agg(F.sum("toxic"), F.count("*")).first()
    n_toxic, n_all = int(sizes[0] or 0), int(sizes[1])
    terms = once.mapInArrow(frugal(counted), "term bigint, toxic bigint, n bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    ratio = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("n") - F.col("toxic") + 0.5) / (n_all - n_toxic + 1))
    best = terms.where(F.col("toxic") >= least_texts).withColumn("ratio", ratio).where(F.col("ratio") >= least_ratio) \
        .orderBy(F.desc(F.col("toxic") * F.log("ratio")), "term").limit(most_terms).collect()
    best.sort(key=lambda r: r["term"] % (1 << 64))
    return np.array([r["term"] % (1 << 64) for r in best], np.uint64), np.log(np.array([r["ratio"] for r in best], np.float64))


@dataclass
class ToxicityModel:
    lexicon: np.ndarray
    weights: np.ndarray
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base_rate: float

    def scored(self, df: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
        """``df`` with column ``out``: 0 to 1, the calibrated probability of the toxic label."""
        if self.trees is None:
            return df.withColumn(out, F.lit(self.base_rate))
        rows = df.withColumn("__features", array_to_vector(features(F.col(text), self.lexicon, self.weights)))
        rows = self.trees.transform(rows).withColumn("__raw", vector_to_array("__probability")[1])
        if self.calibration is None:
            return rows.withColumn(out, F.col("__raw")).drop("__features", "__rawPrediction", "__probability", "__prediction", "__raw")
        rows = self.calibration.transform(rows)
        # the trees' own order inside a step of the calibration
        return rows.withColumn(out, 0.99 * F.col("__calibrated") + 0.01 * F.col("__raw")) \
            .drop("__features", "__rawPrediction", "__probability", "__prediction", "__raw", "__calibrated")


def labelled_sample(docs: DataFrame, labels: DataFrame, doc: str, label: str, text: str, most: int) -> DataFrame:
    """(text, toxic, part) of at most ``most`` labelled rows, chosen by the hash of their id; written once.

    The sample's ids are small by that bound, so texts are found without a shuffle.
    """
    chosen = labels.where(F.col(doc).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc).alias("__doc")) \
        .agg(F.max(F.col(label)).alias("__toxic")).orderBy(F.xxhash64("__doc"), "__doc").limit(most)
    rows = docs.select(doc, text).join(F.broadcast(chosen), F.col(doc) == F.col("__doc"))
    return written(rows.select(F.coalesce(text, F.lit("")).alias("text"), (F.col("__toxic") == 1).cast("int").alias("toxic"),
                               F.pmod(F.xxhash64("__doc", F.lit("part")), F.lit(10)).cast("int").alias("part")), "labelled")


def fit(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", label: str = "toxic", text: str = "text",
        most_rows: int = 20_000, seed: int = 7) -> ToxicityModel:
    """A model from the rows of ``docs`` that ``labels`` names; null labels are left out.

    At most ``most_rows`` labelled rows are used (a documented bound on the
    fit, not on the scoring). Without both labels among the rows for the
    trees every text gets the label's smoothed share.
    """
    rows = labelled_sample(docs, labels, doc, label, text, most_rows)
    lexicon, weights = learn_lexicon(rows.where("part < 5"))
    vectors = written(rows.where("part >= 5").select("toxic", "part", features(F.col("text"), lexicon, weights).alias("f")), "toxicity-features")
    vectors = vectors.select("toxic", "part", array_to_vector("f").alias("__features"))
    known = {(r[0], r[1]): r[2] for r in vectors.groupBy((F.col("part") < 8).cast("int"), "toxic").count().collect()}
    base = (sum(n for (_, t), n in known.items() if t) + 1) / (sum(known.values()) + 2)
    if not known.get((1, 0)) or not known.get((1, 1)):
        return ToxicityModel(lexicon, weights, None, None, base)
    trees = GBTClassifier(featuresCol="__features", labelCol="toxic", predictionCol="__prediction",
                          maxIter=20, maxDepth=3, stepSize=0.3, maxBins=64, seed=seed) \
        .setProbabilityCol("__probability").setRawPredictionCol("__rawPrediction").fit(vectors.where("part < 8"))
    if not known.get((0, 0)) or not known.get((0, 1)):
        return ToxicityModel(lexicon, weights, trees, None, base)
    held = trees.transform(vectors.where("part >= 8")).select("toxic", vector_to_array("__probability")[1].alias("__raw"))
    calibration = IsotonicRegression(featuresCol="__raw", labelCol="toxic", predictionCol="__calibrated").fit(held)
    return ToxicityModel(lexicon, weights, trees, calibration, base)
