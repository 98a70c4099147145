import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wikipassages.llm import brown


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _rows(n=400, seed=3):
    """Sentences of alternating word kinds, so that classes predict what follows."""
    r = random.Random(seed)
    nouns, verbs = [f"n{i}o" for i in range(40)], [f"v{i}e" for i in range(40)]
    rows = [(i, " ".join(r.choice(nouns if k % 2 == 0 else verbs) for k in range(r.randint(5, 60)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "N1o\x0bV2E unseenword É"), (n + 2, "N1o\x0bV2E unseenword É"), (None, "n1o v1e"), (n + 3, "rare1 n1o " * 500)]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(_rows(), "doc_id long, text string").withColumns({"train": F.col("doc_id") % 7 != 2, "n_known": F.lit("x"), "row": F.lit(0)})
    return df, brown.scored(df, "train").collect()


def test_base_equals_brute_force(scored):
    rows, out = _rows(), scored[1]
    assert len(out) == len(rows)
    count = Counter()
    for doc, text in rows:
        if doc is not None and doc % 7 != 2:
            count.update(_words(text) + [None])
    n, v = sum(count.values()), len(count)
    for r in out:
        tokens = _words(r["text"]) + [None]
        assert r["base_score"] == pytest.approx(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens), rel=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(count[t] > 0 for t in tokens), n)


def test_classes_beat_unigrams_on_held_out_texts(scored):
    held = [r for r in scored[1] if r["doc_id"] is not None and r["doc_id"] % 7 == 2 and r["doc_id"] < 400]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.1 * sum(r["n_tokens"] for r in held)


def test_exchange_raises_the_likelihood_and_is_a_distribution(spark):
    df = spark.createDataFrame([t for t in _rows() if t[0] is not None], "row long, text string").withColumns({"row": F.monotonically_increasing_id(), "train": F.lit(True)}).select("row", "train", "text")
    counts = df.mapInArrow(brown._counted, "hash bigint, ending int, n bigint").groupBy("hash").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))
    v = brown._vocabulary(counts, df.count())
    units = df.mapInArrow(lambda b: brown._as_units(b, v), brown.UNITS)
    before, after = brown.exchange(units.select("units"), v, 0), brown.exchange(units.select("units"), v, 6)
    assert np.allclose((10.0 ** after.log_step).sum(1), 1)
    values = []
    for classes in (before, after):
        table = brown._neighbours(units.select("units"), classes.of_unit, len(classes.log_step))
        matrix = brown._class_matrix(table, classes.of_unit, len(classes.log_step))
        assert matrix.sum() == sum(len(_words(t)) + 1 for _, t in _rows() if _ is not None)
        values.append(brown.likelihood(matrix))
    assert values[1] > values[0]


def test_rows_beyond_the_local_counts_are_joined(spark, monkeypatch, scored):
    monkeypatch.setattr(brown, "KEPT", 0.02)
    monkeypatch.setattr(brown, "CLASSED", 0.02)
    again = brown.scored(scored[0], "train").collect()
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], round(r["base_score"], 6))
    for a, b in zip(sorted(scored[1], key=key), sorted(again, key=key)):
        assert a["base_score"] == pytest.approx(b["base_score"], rel=1e-9) and a["n_known"] == b["n_known"]


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").withColumn("train", F.lit(None).cast("boolean"))
    out = brown.scored(df, "train").collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in out)
    assert brown.scored(df.limit(0), "train").count() == 0


def _mixed(n=600, seed=5):
    """Alternating kinds again, a third of the words rare; the endings of rare words do not tell their kind."""
    r = random.Random(seed)
    word = lambda kind: f"{kind}{r.randrange(8)}" if r.random() < 0.66 else f"{kind}rare{r.randrange(150)}x"
    return [(i, True, " ".join(word("nv"[k % 2]) for k in range(20))) for i in range(n)]


def test_words_below_the_share_are_exchanged_too(spark, monkeypatch):
    """rare words get the class that their neighbours call for, not only that of their ending."""
    monkeypatch.setattr(brown, "CLASSED", 0.01)
    rows, count = _mixed(), Counter(w for _, _, t in _mixed() for w in t.split())
    pairs = [(f"nrare{i}x", f"vrare{j}x") for i in range(150) for j in range(150)
             if i % 10 == j % 10 and count[f"nrare{i}x"] == count[f"vrare{j}x"] >= 5][:20]
    assert len(pairs) > 10 and all(c < 0.01 * sum(count.values()) for w, c in count.items() if "rare" in w)
    asked = [(-2 * k - 1 - right, False, f"n0 {pair[right]} n0") for k, pair in enumerate(pairs) for right in (0, 1)]
    out = {r["doc"]: r["score"] for r in brown.scored(spark.createDataFrame(rows + asked, "doc long, train boolean, text string"), "train").collect()}
    gains = [out[-2 * k - 2] - out[-2 * k - 1] for k in range(len(pairs))]
    assert np.median(gains) > 0.5 and np.mean(np.array(gains) > 0) > 0.9


def test_rare_words_move_by_the_rule_of_the_exchange(spark):
    """The bulk step gives a word the class and gain that trying each class gives it."""
    r = np.random.default_rng(1)
    n = brown.EXCHANGED + brown.ENDINGS + 1
    matrix = r.integers(0, 50, (n, n)) + 20
    hashes = np.array([-7, 3, 9, 11], np.int64)
    before, after = ([r.integers(0, n, k).astype(np.uint8) for k in (1, 2, 5, 9)] for _ in range(2))
    table = brown.pa.table({"hash": hashes, "own": np.array([50, 60, 70, 80], np.int32), "before": [x.tobytes() for x in before], "after": [x.tobytes() for x in after]})
    batches = brown.pa.Table.from_batches([b for b in table.to_batches(max_chunksize=1)]).to_batches()
    found = [x for b in brown._bests(iter(batches), matrix) for x in b.to_pylist()]
    assert [x["hash"] for x in found] == hashes.tolist() and [x["n"] for x in found] == [1, 2, 5, 9]
    for i, own in enumerate((50, 60, 70, 80)):
        def value(k):
            succ, pred = np.bincount(after[i], minlength=n), np.bincount(before[i], minlength=n)
            m, x, a, b, t = matrix, brown._xlogx, matrix.sum(1), matrix.sum(0), len(after[i])
            return (x(m[k] + succ) - x(m[k])).sum() + (x(m[:, k] + pred) - x(m[:, k])).sum() - (x(a[k] + t) - x(a[k])) - (x(b[k] + t) - x(b[k]))
        succ, pred, x, t = np.bincount(after[i], minlength=n), np.bincount(before[i], minlength=n), brown._xlogx, len(after[i])
        leave = (x(matrix[own] - succ) - x(matrix[own])).sum() + (x(matrix[:, own] - pred) - x(matrix[:, own])).sum() \
            - (x(matrix.sum(1)[own] - t) - x(matrix.sum(1)[own])) - (x(matrix.sum(0)[own] - t) - x(matrix.sum(0)[own]))
        values = np.array([value(k) for k in range(brown.EXCHANGED)])
        assert found[i]["to"] == (int(values.argmax()) if values.max() + leave > 1e-9 else -1)
