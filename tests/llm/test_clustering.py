from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from bazaarcube.llm import clustering
from bazaarcube.llm.queries import ORACLE_SQL

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k, rounds, scale, dim):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = [(hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "~", v) for i, v in good]
    middle = [v for _, v in sorted(key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(middle))

    for _ in range(rounds):
        found = [near(v)[1] for _, v in good]
        for j in range(len(middle)):
            own = [v for (_, v), f in zip(good, found, strict=True) if f == j]
            if own:
                middle[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [near(v) for _, v in good]
    inertia = [sum(d for d, j in last if j == c) for c in range(len(middle))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, j, d, inertia[j], sum(inertia), sha[j]) for (i, _), (d, j) in zip(good, last, strict=True)), key=repr)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, apex string").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = clustering.cluster(df, **kw)
    assert found.columns == COLUMNS
    want = brute(rows, kw.get("k", 8), kw.get("rounds", 10), kw.get("scale", 1024), kw["dim"])
    assert sorted(map(tuple, found.collect()), key=repr) == want


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25, 0.0]), (1, [0.5, 0.5, 0.5]), (2, None), (3, [nan, 0.0, 0.0]), (4, []), (5, [inf, 1.0, 1.0]), (6, [None, 1.0, 1.0]),
        (None, [1.0, 1.0, 1.0]), (7, [0.0, 0.0, 0.0]), (8, [0.5, 0.5, 0.5]), (8, [0.5, 0.5, 0.5]), (9, [-1.0, -1.0, -1.0]), (9, [1.0, 2.0, 3.0]), (12, [1.0, 1.0]),
    ]
    for k in (2, 4, 20):
        check(spark, rows, k=k, rounds=3, dim=3)
    check(spark, [(i, [0.25, 0.5]) for i in range(30)], k=4, dim=2)  # equal vectors: all in cluster 0
    assert clustering.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>")).columns == COLUMNS
    assert clustering.cluster(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0
    with pytest.raises(Exception, match="beyond"):
        clustering.cluster(spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>"), dim=2).count()


def test_many_vectors_ties_and_a_hot_group(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 6)) + rng.integers(0, 4, 600)[:, None] * 2
    x[200:400] = x[0]
    x[500:] = np.round(x[500:])  # many equal distances
    check(spark, [(i, [float(v) for v in row]) for i, row in enumerate(x)], k=8, dim=6, scale=2.0)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    centers = rng.integers(-2000, 2000, (8, 64))
    x = centers[rng.integers(0, 8, 3000)] + rng.integers(-60, 60, (3000, 64))
    simplex = clustering.Simplex(x[:16])
    low, high = simplex.bounds(simplex.apexes(x), simplex.apexes(centers))
    exact = ((x[:, None] - centers) ** 2).sum(2)
    assert (low <= exact).all() and (exact <= high).all()
    best, exact_distances = clustering.nearest(simplex, x, simplex.apexes(x), centers)
    assert (best == exact.argmin(1)).all()
    assert exact_distances < 0.1 * exact.size


def test_dependent_pivots_are_left_out():
    base = np.array([[0, 0, 0], [10, 0, 0], [20, 0, 0], [5, 0, 0], [0, 7, 0], [10, 0, 0]])
    assert clustering.Simplex(base).pivots.tolist() == [[0, 0, 0], [10, 0, 0], [0, 7, 0]]
    far = np.array([[1 << 26] * 3, [-(1 << 26)] * 3])
    simplex = clustering.Simplex(base)
    low, high = simplex.bounds(simplex.apexes(far), simplex.apexes(base))
    exact = ((far[:, None] - base) ** 2).sum(2)
    assert (low <= exact).all() and (exact <= high).all()


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = clustering.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = db.sql(ORACLE_SQL["op11_simplex_clustering"]).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want)
