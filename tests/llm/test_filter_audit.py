"""The audit against a plain run of every order, row by row."""

import random
from itertools import permutations

import numpy as np

from wikipassages.llm import filter_audit as fa


def test_sorted_lists():
    rng = np.random.Generator(np.random.PCG64(1))
    for _ in range(200):
        lists = [np.unique(rng.integers(0, rng.integers(1, 80), rng.integers(0, 60))).astype(np.int64) for _ in range(4)]
        assert fa.union(lists).tolist() == sorted(set().union(*map(set, lists)))
        assert fa.difference(lists[0], lists[1:]).tolist() == sorted(set(lists[0]) - set().union(*map(set, lists[1:])))
        assert fa.found_in(lists[0], lists[1]).tolist() == [x in set(lists[1]) for x in lists[0]]


def plain(rows, filters):
    """rows: (part, failing names, good, toxic)."""
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys(filters, 0)
        for order in permutations(filters):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone),
                                                   sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone), f]
        for key in [k for k in out if k[0] == part]:
            out[key][6] = shapley[out[key][6]]
    return {k: tuple(v) for k, v in out.items()}


def of(df):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                        r["toxic_lost"], r["shapley"]) for r in df.collect()}


def test_every_order(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice(["x", "x", "x", "y", ""]), {f for f in "ABCD" if rng.random() < 0.35}, rng.random() < 0.4, rng.random() < 0.2)
            for _ in range(400)]
    rows += [("clean", set(), True, False), ("bad", set("ABCD"), False, True)]
    table = [(None if p == "" and i % 2 else p, *[f in bad if i % 3 or f in bad else None for f in "ABCD"], g, t if t else None)
             for i, (p, bad, g, t) in enumerate(rows)]
    df = spark.createDataFrame(table, "part string, A boolean, B boolean, C boolean, D boolean, good boolean, toxic boolean").repartition(3)
    monkeypatch.setattr(fa, "RANGE_BITS", 5)
    assert of(fa.audit(df, list("ABCD"), "part", "good", "toxic")) == plain(rows, "ABCD")
    assert fa.audit(df.limit(0), list("ABCD"), "part", "good", "toxic").count() == 0


def test_documents(spark, monkeypatch):
    long_text = " ".join(f"w{i}" for i in range(250))
    docs = [(1, long_text, "en"), (2, long_text, "de"), (2, long_text, "en"), (3, None, None), (4, "", ""), (5, "A B C " * 100, "en"),
            (6, "a b " * 150 + "#", "en"), (None, long_text, "en"), (7, "ß ñ " * 200 + "ABC", "en")]
    labels = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (4, 1, 0), (None, 1, 1), (99, 1, 1)]

    def fails(doc, text):
        t = text or ""
        words = t.split()
        bad = {"A"} if len(words) < 200 else set()
        bad |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        bad |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else set()
        bad |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        ids = [d for d, x, _ in docs if (x or "") == t and d is not None]
        return bad | ({"E"} if doc is not None and min(ids) < doc else set())
    good, toxic = {1, 2, 4}, {2}
    want = plain([(lang or "", fails(d, t), d in good, d in toxic) for d, t, lang in docs], "ABCDE")
    tables = (spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("digest", fa.F.lit("x")).withColumn("n", fa.F.lit(1)),
              spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert of(fa.audited_documents(*tables)) == want
    monkeypatch.setattr(fa, "HOT_SHARE", 2)          # only groups of half the rows are told by the broadcast
    assert of(fa.audited_documents(*tables)) == want
