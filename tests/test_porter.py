"""The stemmer as a column expression against the word-by-word algorithm."""

import random

from pyspark.sql import functions as F

import porter_words
from wikipassages.functions import porter

CLASSIC = {"caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "feed": "feed", "plastered": "plaster", "motoring": "motor",
           "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky",
           "relational": "relat", "hopefulness": "hope", "rate": "rate", "cease": "ceas", "controlling": "control", "is": "is"}


def test_classic_pairs_and_random_words(spark):
    r = random.Random(1)
    suffixes = [s for s, _ in porter.STEP2 + porter.STEP3] + porter.STEP4 + ["ed", "ing", "eed", "s", "sses", "ies", "y", "e", "ll"]
    words = set(CLASSIC) | {"y", "yy", "yyy", "syzygy", "saying", "toy", "ayyed", "xyyed", "é", ""}
    for _ in range(1500):
        words.add("".join(r.choice("aeiouybcdlstzrwxé") for _ in range(r.randint(1, 6)))
                  + "".join(r.choice(suffixes) for _ in range(r.randint(0, 3))))
    out = {x["w"]: x["s"] for x in spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
           .select("w", porter.stem(F.col("w")).alias("s")).collect()}
    assert out.pop(None) is None
    assert all(out[w] == s for w, s in CLASSIC.items())
    assert {w: s for w, s in out.items() if s != porter_words.stem(w)} == {}
