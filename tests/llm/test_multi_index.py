import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wikipassages.llm import multi_index


def brute(ids, x, cosine):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= cosine
    degree, parent = near.sum(1) - 1, list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        a, b = root(i), root(j)
        if a != b:
            keep, go = (a, b) if ids[a] < ids[b] else (b, a)
            parent[go] = keep
    return {int(d): (int(degree[i]), int(ids[root(i)])) for i, d in enumerate(ids)}


def _vectors():
    """Clusters whose pairs lie on both sides of the threshold, exact copies, a large tight group."""
    rng = np.random.default_rng(6)
    rows = [rng.normal(size=(300, 16))]
    for spread in (0.02, 0.1, 0.2, 0.3):
        rows.append(rng.normal(size=16) + spread * rng.normal(size=(60, 16)))
    rows.append(np.repeat(rng.normal(size=(1, 16)), 100, axis=0))
    rows.append(3 * rows[1][:20])
    x = np.concatenate(rows).astype(np.float32).astype(np.float64)
    return rng.permutation(len(x)) * 3, x


@pytest.mark.parametrize("block", [4096, 16])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "PER_CELL", 16)
    ids, x = _vectors()
    df = spark.createDataFrame([(int(i), v.tolist(), "a") for i, v in zip(ids, x)], "vec_id long, embedding array<float>, rep string").repartition(3)
    out = {r["vec_id"]: r for r in multi_index.near_copies(df, recall=0.9999).collect()}
    expected = brute(ids, x, 0.9)
    assert len(out) == len(ids)
    found = sum(r["n_links"] for r in out.values())
    assert found >= 0.98 * sum(d for d, _ in expected.values())
    assert all(out[i]["n_links"] <= d for i, (d, _) in expected.items())
    assert sum(out[i]["component_id"] == c for i, (_, c) in expected.items()) >= 0.98 * len(ids)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())


def test_both_ends_count_a_link_that_one_side_finds(spark, monkeypatch):
    """Pairs at the threshold (one end in two copies) with a bound so tight that many are found from one side only."""
    monkeypatch.setattr(multi_index, "PER_CELL", 16)
    rng = np.random.default_rng(8)
    x, noise = rng.normal(size=(2, 1200, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise -= (noise * x).sum(1, keepdims=True) * x
    y = 0.905 * x + math.sqrt(1 - 0.905 ** 2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    rows = [(3 * i + k, v.tolist()) for i, (a, b) in enumerate(zip(x, y)) for k, v in enumerate((a, b, b))]
    exact = brute(np.array([i for i, _ in rows]), np.array([v for _, v in rows]), 0.9)
    n = {r["vec_id"]: r["n_links"] for r in multi_index.near_copies(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), recall=0.5).collect()}
    apart = [i for i in range(1200) if all(exact[3 * i + k][0] == 2 for k in range(3))]
    pairs = [tuple(n[3 * i + k] for k in range(3)) for i in apart]
    assert len(apart) > 500 and set(pairs) == {(2, 2, 2), (0, 1, 1)}


def test_unusable_vectors_link_with_nothing(spark):
    good = [float(i % 3 + 1) for i in range(8)]
    rows = [(1, good), (2, good), (2, good), (3, None), (4, [0.0] * 8), (5, [float("nan")] + good[1:]), (6, [float("inf")] + good[1:]),
            (7, [None] + good[1:]), (8, good[:4]), (9, []), (None, good), (10, [-v for v in good]), (11, [1e-40 * v for v in good])]
    out = multi_index.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == len(rows)
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out}
    assert got == {(1, 2, 1, True), (2, 2, 1, False), (11, 2, 1, False), (None, 0, None, True)} | \
        {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)}


def test_empty_and_useless_tables(spark):
    assert multi_index.near_copies(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    only = spark.createDataFrame([(1, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in multi_index.near_copies(only).collect()] == [(1, 0, 1, True)]
    assert multi_index.near_copies(only.withColumn("embedding", F.lit(None).cast("array<float>"))).count() == 1
