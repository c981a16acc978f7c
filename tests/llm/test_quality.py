from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bazaarcube.llm import doc_stats, quality, queries
from tests.llm.conftest import TEXTS

SF = "/root/testdata/sf0.1"


def plain_statistics(text):
    data = (text or "").encode()
    words = data.lower().split()
    lines = [x for x in data.lower().split(b"\n") if x]
    n, w = max(len(data), 1), max(len(words), 1)
    tops = Counter(words).most_common(1)
    out = [math.log1p(len(data)), math.log1p(len(words))]
    out += [sum(data.count(bytes([b])) for b in group) / n for group in doc_stats._GROUPS.values()]
    out += [sum(data.count(bytes([b])) for b in signs) / w for signs in doc_stats._SIGNS.values()]
    out += [sum(map(len, words)) / w, len(set(words)) / w, (tops[0][1] if tops else 0) / w]
    out += [math.log1p(len(lines)), math.log1p(len(data) / max(len(lines), 1)), (len(lines) - len(set(lines))) / max(len(lines), 1)]
    counts = Counter(data).values()
    return [*out, -sum(c / n * math.log2(c / n) for c in counts)]


def test_statistics_against_a_plain_version(monkeypatch):
    texts = [t for _, t in TEXTS]
    want = np.array([plain_statistics(t) for t in texts])
    assert want.shape[1] == len(doc_stats.NAMES)
    assert np.allclose(doc_stats.statistics(pa.array(texts)), want)
    monkeypatch.setattr(doc_stats, "WINDOW", 64)  # windows that end inside texts
    assert np.allclose(doc_stats.statistics(pa.array(texts)), want)
    assert doc_stats.statistics(pa.array([], pa.string())).shape == (0, len(doc_stats.NAMES))


def test_splits_are_the_best_ones():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (300, 3)).astype(float)
    g, h = rng.normal(size=300), rng.random(300)
    node = rng.integers(0, 2, 300)
    edges = quality.bin_edges(x)
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    gain, f, b = quality.best_splits(binned, node, 2, g, h, 8)
    for n in range(2):
        best = -np.inf
        for i in range(3):
            for cut in range(5):
                lo, hi = (node == n) & (x[:, i] <= cut), (node == n) & (x[:, i] > cut)
                if h[lo].sum() >= quality.LEAST and h[hi].sum() >= quality.LEAST:
                    value = sum(g[p].sum() ** 2 / (h[p].sum() + quality.RIDGE) for p in (lo, hi))
                    best = max(best, value - g[node == n].sum() ** 2 / (h[node == n].sum() + quality.RIDGE))
        assert np.isclose(gain[n], best)


def test_flattened_trees_against_a_plain_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = quality.grow(x, y, trees=12, depth=3, bins=16)
    got = forest.scores(x)
    for row, p in zip(x, got, strict=True):
        z = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] + int(row[forest.feature[node]] > forest.cut[node])
            z += forest.value[node]
        assert math.isclose(p, 1 / (1 + math.exp(-z)))
    assert ((got >= 0.5) == y).mean() > 0.95
    assert len(forest.roots) == 12 and np.diff(forest.roots).max() <= 15


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op12_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    test = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert len(test) > 300 and sum(p == y for p, y in test) > 0.97 * len(test)


def test_held_out_labels_are_not_learned(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} " * (i % 13 + 1)) for i in range(200)], "doc_id long, text string")
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) == 2
    labels = docs.select("doc_id", (F.col("doc_id") % 13 > 6).cast("int").alias("quality"))
    other = labels.select("doc_id", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"))
    a, b = (sorted(map(tuple, quality.score(docs, quality.fit(docs, given)).collect())) for given in (labels, other))
    assert a == b


def test_awkward_documents_and_labels(spark, awkward, no_docs, no_labels):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 0, None), (None, 1, 1), (3, None, None), (99, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, no_labels):
        forest = quality.fit(awkward, given)
        found = quality.score(awkward, forest)
        assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == awkward.count()
        assert quality.score(no_docs, forest).count() == 0
    assert {r.score for r in found.collect()} == {0.5}  # nothing was learned
    assert quality.score(awkward, quality.fit(no_docs, labels)).count() == awkward.count()
