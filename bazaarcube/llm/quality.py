"""Document quality by histogram gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows (``MAX_ROWS``, by the hash of
their id): Spark computes the statistics of the sampled documents, and each statistic is
cut into at most ``BINS`` bins at the sample's quantiles. A tree grows level by level
from histograms of gradients and curvatures over (node, statistic, bin); splits are the
best ones over all bins. Finished trees are flattened into arrays (statistic, cut,
left child, value), and scoring walks all trees for all documents of a batch at once,
one numpy step for each level. Scoring is one pass over the documents.

Defined cases: null and empty texts have all statistics 0 and are scored like any other;
labels without id or value are ignored, of repeated ones the largest counts; of rows
with one id one is learned from; with no labels the score is 0.5, with one kind of label
its smoothed rate; rows without an id are scored, are not held out and never learned
from. Repeated rows are scored like any other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarcube.llm import doc_stats
from bazaarcube.llm.tables import Shared, remainder
from bazaarcube.llm.textops import slices

#: Labelled rows used for fitting at most.
MAX_ROWS = 20_000
BINS = 128
TREES = 60
DEPTH = 4
RATE = 0.2
#: Ridge on leaf values, and the least curvature of a child.
RIDGE, LEAST = 1.0, 1.0
ACCEPT = 0.7
FOLDS, HELD_OUT = 4, 2
#: Nodes walked at a time: rows x trees.
_WALK = 1 << 20


@dataclass
class Forest:
    """Flattened trees: in node i a row with ``x[feature[i]] <= cut[i]`` goes to
    ``left[i]``, else to the node after it; a leaf leads to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        step = max(1, _WALK // max(1, len(self.roots)))
        for lo in range(0, len(x) if len(self.roots) else 0, step):
            part = x[lo : lo + step]
            row = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                node = self.left[node] + (part[row, self.feature[node]] > self.cut[node])
            out[lo : lo + step] += self.value[node].sum(1)
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """The cuts of each statistic: its sample quantiles without repetition. The largest
    value is no cut."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
            values = values[values < column.max()]
        else:
            values = values[:-1]
        out.append(values)
    return out


def best_splits(binned: np.ndarray, node: np.ndarray, n_nodes: int, g: np.ndarray, h: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, statistic and bin of the best split of each node, from histograms."""
    n_features = binned.shape[1]
    key = ((node[:, None] * n_features + np.arange(n_features)) * bins + binned).ravel()
    size = n_nodes * n_features * bins
    shape = (n_nodes, n_features, bins)
    gl = np.bincount(key, np.repeat(g, n_features), size).reshape(shape).cumsum(2)
    hl = np.bincount(key, np.repeat(h, n_features), size).reshape(shape).cumsum(2)
    g_all, h_all = gl[:, :1, -1:], hl[:, :1, -1:]
    gr, hr = g_all - gl, h_all - hl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g_all**2 / (h_all + RIDGE)
    gain[(hl < LEAST) | (hr < LEAST)] = -np.inf
    flat = gain.reshape(n_nodes, -1)
    at = flat.argmax(1)
    return flat[np.arange(n_nodes), at], at // bins, at % bins


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Boosted trees for 0/1 labels ``y``."""
    ones = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(ones / (1 - ones)))
    feature, cut, left, value, roots = [], [], [], [], []
    if len(y) and y.min() < y.max():
        edges = bin_edges(x, bins)
        binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
        z = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p)
            root = len(feature)
            feature.append(0), cut.append(np.inf), left.append(root), value.append(0.0)
            place = np.full(len(y), root)  # the node of each row
            level = np.array([root])
            for _ in range(depth):
                local = np.searchsorted(level, place)
                inside = (local < len(level)) & (level[np.minimum(local, len(level) - 1)] == place)
                gain, f, b = best_splits(binned[inside], local[inside], len(level), g[inside], h[inside], bins)
                below = []
                for i in np.flatnonzero(gain > 1e-9):
                    node, child = level[i], len(feature)
                    feature[node], cut[node], left[node] = int(f[i]), float(edges[f[i]][b[i]]), child
                    for leaf in (child, child + 1):
                        feature.append(0), cut.append(np.inf), left.append(leaf), value.append(0.0)
                    rows = place == node
                    place[rows] = child + (binned[rows, f[i]] > b[i])
                    below += [child, child + 1]
                if not below:
                    break
                level = np.array(below)
            g_leaf, h_leaf = np.bincount(place, g, len(feature)), np.bincount(place, h, len(feature))
            leaves = np.arange(root, len(feature))
            leaves = leaves[np.array(left)[leaves] == leaves]
            for leaf in leaves:
                value[leaf] = RATE * float(g_leaf[leaf] / (h_leaf[leaf] + RIDGE))
            z += np.array(value)[place]
            roots.append(root)
    return Forest(np.array(feature, np.int64), np.array(cut), np.array(left, np.int64), np.array(value), np.array(roots, np.int64), depth, base)


def learned_from(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, FOLDS) != HELD_OUT, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``max_rows`` labelled documents."""
    picked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learned_from(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("doc_id")).agg(F.max(F.col(label)).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = doc_stats.statistics(batch.column("text"))
            at = np.arange(0, x.size + 1, x.shape[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.ListArray.from_arrays(pa.array(at), pa.array(x.ravel()))], names=["doc_id", "y", "x"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, y double, x array<double>")
    table = found.groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("s")).orderBy(F.xxhash64("doc_id"), "doc_id").select("s.x", "s.y").toArrow()
    x = np.array(table.column("x").to_pylist(), float).reshape(-1, len(doc_stats.NAMES))
    return x, table.column("y").to_numpy().astype(float)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Forest:
    return grow(*sample(docs, labels, label, max_rows))


def score(docs: DataFrame, forest: Forest, accept: float = ACCEPT) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    shared = Shared(docs.sparkSession, forest)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.get()
        for batch in slices(batches):
            p = trees.scores(doc_stats.statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p), pa.array((p >= accept).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
    held_out = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")
