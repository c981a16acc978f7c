from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from bazaarcube.llm import topk


def brute_topk(rows, is_query, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, q in good:
        if is_query(i):
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def check(spark, rows, every, k=5):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got: dict = {}
    for r in sorted(topk.search(df, F.col("vec_id") % every == 0, k).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = brute_topk(rows, lambda i: i % every == 0, k)
    assert got == {i: best for i, best in want.items() if best}


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25, 0.0]), (1, [0.5, 0.5, 0.5]), (2, None), (3, [nan, 0.0, 0.0]), (4, []), (5, [inf, 1.0, 1.0]),
        (6, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (7, [0.0, 0.0, 0.0]), (8, [0.5, 0.5, 0.5]), (9, [-1.0, -1.0, -1.0]),
        (10, [0.0, 0.0, 0.0]), (11, [0.001, -0.001, 0.0]), (12, [1.0, 1.0]), (20, [1.0, -1.0]),
    ]
    check(spark, rows, 10)
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") == 0).count() == 0


def test_many_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 100)
    monkeypatch.setattr(topk.pack, "__defaults__", (100,))
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 8))
    x[300:420] = x[0]  # a common vector, so equal scores
    x[500:] = np.round(x[500:])
    check(spark, [(i, [float(v) for v in row]) for i, row in enumerate(x)], 5)


def test_reading_stops_early():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 2)) * 256
    x = np.floor(x).astype(np.int64)
    seen = []

    class Spy(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    found = list(topk.threshold_topk(np.arange(4000), x.view(Spy), np.array([-1]), np.array([[300, 7]]), 5))
    scores = x @ np.array([300, 7])
    assert list(found[0][2]) == sorted(scores, reverse=True)[:5]
    assert sum(seen) < 2000
