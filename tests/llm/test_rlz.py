import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wikipassages.llm import rlz


def brute(rows, size):
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - size + 1):
            if doc is not None:
                key = tuple(words[i:i + size])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words, gone = (text or "").encode().split(), set()
        for i in range(len(words) - size + 1):
            if doc is not None and first[tuple(words[i:i + size])] < doc:
                gone |= set(range(i, i + size))
        out.append((doc, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return sorted(out, key=str)


def _rows():
    r = random.Random(5)
    letters = "a b c d e f g h i j k l m n o"
    rows = [(None, letters), (7, None), (8, ""), (9, "x"), (9, "x"), (3, letters), (3, letters), (2, letters[:-2]), (4, "w " * 3000)]
    rows += [(r.randint(0, 400), " ".join(r.choice("abc") for _ in range(r.randint(0, 60)))) for _ in range(200)]
    base = [" ".join(r.choice(["u", "v", "w", "xé", "y", "z"]) for _ in range(40)) for _ in range(4)]
    # a passage that a third of all rows share
    rows += [(500 + i, " ".join(r.choice("pqr") for _ in range(10)) + " " + r.choice(base) + "\n" + " ".join(r.choice("pqr") for _ in range(10)))
             for i in range(100)]
    return rows


@pytest.mark.parametrize("size", [13, 5])
def test_equals_brute_force(spark, size):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ref": F.lit(1), "doc": F.lit("x"), "mark": F.lit(2)}).repartition(3)
    out = rlz.parsed(df, window=size).collect()
    assert sorted([(r.doc_id, r.parsed.n_words, r.parsed.n_removed, r.parsed.kept) for r in out], key=str) == brute(rows, size)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append((t or "").split())
    by_text = {(d, t): t.split() for d, t in rows if t}
    for r in out:
        covered = set()
        for f in r.parsed.factors:
            assert f.length >= size and f.ref < r.doc_id
            covered |= set(range(f.start, f.start + f.length))
            # a factor is a stretch of its reference, word by word (of one of the texts, where several have its id)
            own = [t[f.start:f.start + f.length] for (d, _), t in by_text.items() if d == r.doc_id]
            assert any(t[f.at:f.at + f.length] in own for t in texts[f.ref])
        assert len(covered) == r.parsed.n_removed


def test_passages_over_slices_and_partitions(spark, monkeypatch):
    """The same result however rows are dealt and sliced."""
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = rlz.parsed(df.coalesce(1)).select("doc_id", "parsed.kept").collect()
    many = rlz.parsed(df.repartition(40)).select("doc_id", "parsed.kept").collect()
    assert sorted(one, key=str) == sorted(many, key=str)


def _words_with_windows(monkeypatch, value):
    """What the blocks find for two texts with one anchor, whose windows' hashes are ``value`` of the document."""
    texts = pa.array(["a b c d e f", "g h i j k l"])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([7, 8], pa.int32()), texts], ["doc", "mark", "text"])
    starts = np.array([0, 6])
    monkeypatch.setattr(rlz, "runs_of", lambda w, window: (np.full(2, 5, np.uint64), starts, np.ones(2, np.int64), np.repeat(
        np.array([value(1), value(2)], np.uint64), 6)))
    runs = pa.Table.from_batches(rlz.emitted_runs(iter([batch]), 6)).sort_by([("key", "ascending"), ("doc", "ascending")]).combine_chunks()
    whole, split = runs.to_batches(), runs.to_batches(max_chunksize=1)
    return [[r for b in rlz.looked_up(iter(x)) for r in b.to_pylist()] for x in (whole, split)]


def test_windows_are_told_apart_by_all_bits(monkeypatch):
    """Windows under one anchor that agree in 32 bits only are different, in one Arrow batch or in two."""
    assert _words_with_windows(monkeypatch, lambda d: 77 + (d << 32)) == [[], []]
    assert _words_with_windows(monkeypatch, lambda d: 77 + (d << 5)) == [[], []]
    whole, split = _words_with_windows(monkeypatch, lambda d: 77)
    assert whole == split and [(r["doc"], r["n"], r["ref"], r["at"]) for r in whole] == [(2, 1, 1, 0)]


def test_packed_runs_are_the_same_runs():
    rows = [(d, t) for d, t in _rows() if d is not None] + [(9000, "one " * 2000)]        # a run of many windows
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows]), pa.array(range(len(rows)), pa.int32()), pa.array([t for _, t in rows])],
                                       ["doc", "mark", "text"])
    runs = list(rlz.emitted_runs(iter([batch.slice(0, 150), batch.slice(150)]), 6))
    sent = list(rlz.packed(iter(runs), 5))
    assert [b.num_rows for b in sent] == [5, 5]
    got = list(rlz.unpacked(iter([b.slice(i) if i else b.slice(0, 1) for b in sent for i in (0, 1)])))
    both = [sorted((tuple(r.values()) for b in x for r in b.to_pylist()), key=str) for x in (runs, got)]
    assert both[0] == both[1] and len(both[0]) > 100
    assert list(rlz.unpacked(rlz.packed(iter([]), 5))) == []


def test_factors_go_on_over_boundaries_and_references(spark):
    """A stretch of two references is two factors, also where windows cross from one to the other; a gap in the reference ends a factor."""
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [(1, " ".join(a)), (2, " ".join(a[-15:] + b)), (3, " ".join(["x"] + a[5:] + b[:30] + ["y"])), (4, " ".join(a[:20] + a[21:]))]
    got = {r.doc_id: [tuple(f) for f in r.parsed.factors] for r in rlz.parsed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [] and got[2] == [(0, 15, 1, 25)]
    assert got[3] == [(1, 35, 1, 5), (24, 42, 2, 3)]
    assert got[4] == [(0, 20, 1, 0), (20, 19, 1, 21)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rlz.parsed(df).count() == 0
