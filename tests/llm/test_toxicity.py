import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wikipassages.llm import toxicity


def _texts(n, seed):
    """Ordinary words; toxic texts hold words that begin with one of two invented roots, some in capitals."""
    r = random.Random(seed)
    words = ["".join(r.choice("aeioubdglmnrst") for _ in range(r.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(r.randint(3, 6)):
                text[r.randrange(len(text))] = r.choice(["zkraff", "QVOLL"]) + r.choice(["", "er", "an", "ung"])
        rows.append((i, " ".join(text), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.createDataFrame(_texts(1500, 1), "doc_id long, text string, toxic int")
    labels = rows.select("doc_id", "toxic").union(rows.limit(3).select("doc_id", F.lit(None).cast("int"))) \
        .union(spark.createDataFrame([(None, 1)], "doc_id long, toxic int"))
    return toxicity.fit(rows.select("doc_id", "text"), labels)


def test_scores_of_other_texts(spark, fitted):
    rows = spark.createDataFrame(_texts(600, 1)[100:] + [(2000 + i, t, x) for i, t, x in _texts(300, 2) if not x], "doc_id long, text string, toxic int")
    scored = fitted.scored(rows.withColumn("score", F.lit("clash"))).collect()
    assert len(scored) == rows.count()
    assert all(0 <= r["score"] <= 1 for r in scored)
    right = sum((r["score"] >= 0.3) == bool(r["toxic"]) for r in scored)
    assert right / len(scored) > 0.97


def test_nulls_empty_long_and_repeated(spark, fitted):
    rows = [(1, None), (2, ""), (3, "word " * 200_000), (4, "QVOLL you zkraffer"), (4, "QVOLL you zkraffer"), (None, "z.k.r.a.f.f z*k")]
    out = fitted.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    same = [r["score"] for r in out if r["doc_id"] == 4]
    assert same[0] == same[1] >= 0.3
    assert [r["score"] for r in out if r["doc_id"] == 1] == [r["score"] for r in out if r["doc_id"] == 2]
    assert fitted.scored(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_without_labels_the_share_is_the_score(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(rows, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] for r in model.scored(rows).collect()] == [0.5, 0.5]


def test_features():
    lexicon = toxicity._listed(["zkraff"])
    def of(text):
        return dict(zip(toxicity.NAMES, toxicity._features(pa.array([text]), lexicon, np.ones(1)).to_pylist()[0]))
    assert of("you zkraff")["near_second_person"] == 0.5 and of("you " + "a " * 9 + "zkraff")["near_second_person"] == 0
    assert of("zkr4ff")["disguised"] == 1 and of("z.k.r.a.f.f")["disguised"] > 0 and of("zkraff")["disguised"] == 0
    assert of("STOP it NOW!!")["capital_words"] == pytest.approx(2 / 3) and of("STOP it NOW!!")["exclamations"] == pytest.approx(2 / 3)
    assert of("1diot x")["mixed_words"] == 0.5 and of("1diot")["disguised"] == 0 and of("idiot")["insults"] == 1
    assert set(of("").values()) == {0.0} and set(of(None).values()) == {0.0}
