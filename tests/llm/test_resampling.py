"""Buckets against zlib, whatever the head holds; the draw against a plain computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from wikipassages.llm import resampling as rs


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_buckets(text):
    w = plain_words(text)
    return [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


TEXTS = [None, "", "One", "one ONE, Été-İ x2 " + "z" * 70 + " end", "...", "a b a b c " * 50, "ß" * 200 + " q", "x\x00y\x7fz _a_b"]


def test_buckets_of_head_and_tail():
    words = rs.lower_words(pa.array(TEXTS))
    assert [bytes(b).decode() for b in rs.word_array(words).to_pylist()] == [w for t in TEXTS for w in plain_words(t)]
    for head in (rs.Head.of([]), rs.Head.of([b"a", b"b"], [1, rs.PAIR_WORDS]), rs.Head.of([b"one", "été".encode(), b"c", b"absent"], [0])):
        single, pair, first = head.buckets(words)
        doc = words.doc_of_word()
        for i, t in enumerate(TEXTS):
            assert sorted([*single[doc == i], *pair[doc[first] == i]]) == sorted(plain_buckets(t))


def plain_draw(docs, target, percent=25, least=20):
    s, t = (Counter(b for text in side for b in plain_buckets(text)) for side in ([x for _, x in docs], target))
    n_s, n_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t))) for b in s}
    out = []
    for doc, text in docs:
        f = plain_buckets(text)
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text)) >= least, None])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0]))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[5] = rank
    return Counter((r[0], r[1], r[2], r[3], r[5]) for r in out)


def test_draw(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "naïve", "q" * 80]

    def text(n):
        return " ".join(vocabulary[min(int(rng.expovariate(0.08)), 62)] for _ in range(n))
    docs = [(i, text(rng.choice([3, 19, 20, 60, 200]))) for i in range(120)] + [(500, None), (501, ""), (7, text(30)), (8, "!!! ???")]
    docs += [(600 + i, "same old text " * 9) for i in range(60)]
    target = [text(40) for _ in range(5)] + [None]
    frames = (spark.createDataFrame(docs, "doc_id long, text string").withColumn("weight", rs.F.lit("x")).repartition(4),
              spark.createDataFrame([(t,) for t in target], "text string"))

    def got(df):
        return Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect())
    want = plain_draw(docs, target)
    ranks = rs.resampled(*frames)
    assert got(ranks) == want
    sampled = rs.sample(frames[0], ranks)
    assert sampled.columns == ["doc_id", "text", "weight"] and sampled.count() >= sum(1 for k in want if k[4])
    for name, value in (("HEAD_WORDS", 3), ("HELD", 10)):
        monkeypatch.setattr(rs, name, value)
    assert got(rs.resampled(*frames)) == want
    assert got(rs.resampled(frames[0], frames[1].limit(0))) == plain_draw(docs, [])
    assert rs.resampled(frames[0].limit(0), frames[1]).count() == 0


def test_frequent_tables(spark):
    docs = spark.createDataFrame([("the cat the dog the cat",), ("THE cat " + "y" * 70,)], "text string")
    words = rs.frequent_words(docs)
    assert words == [b"the", b"cat"]          # seen once: dog; too long: y...
    assert rs.frequent_words(docs, most=1) == [b"the"]
    assert rs.frequent_pairs(docs, words, most=1) == [0 * rs.PAIR_WORDS + 1]
    head = rs.head_of(docs)
    assert head.states.tolist() == [zlib.crc32(w) for w in head.words]
    assert np.array_equal(rs.Head(*head.parts()).pairs, head.pairs)
