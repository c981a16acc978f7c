"""Centroid clustering with exact integers, filtered by n-simplex projection.

Some vectors are pivots; their mutual distances span a simplex. The distances of a
vector to the pivots become the apex of a simplex over that base: coordinates in the
base and, last, the height above it. For two apexes the plain Euclidean distance is a
lower bound of the true distance, and the distance with one height reversed an upper
bound. The apexes of all vectors are computed once and stored with the vectors. A
round projects only the centroids; centroids whose lower bound exceeds the smallest
upper bound are out, and the rest are compared by exact integer distances. The
bounds are widened by more than their rounding error, so the result is that of
comparing everything.

A round is one pass: each task sums its vectors by cluster, and the driver gets one
total for each centroid component. Results do not depend on the partitioning.

Components are floor(scale x component). Centroids start as the vectors with the
smallest hash of seed and id. Defined cases: vectors that are null, of another length,
or hold null or non-finite components take no part; rows without an id take part, but
come last as starting centroids; of rows with one id the smaller vector starts first;
repeated rows are separate rows; with fewer vectors than clusters every vector starts
one, and repeated vectors leave the larger numbers empty; an empty table gives no rows.
Integer components beyond ``LIMIT``, whose squared distances would not fit 64 bits,
are refused with an error. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.llm.tables import Shared
from bazaarcube.llm.topk import finite
from bazaarcube.session import stage

K = 8
ROUNDS = 10
SCALE = 1024.0
DIM = 64
SEED = "3"
PIVOTS = 16
#: Largest component; 64 squared differences of such stay below 2**60.
LIMIT = 1 << 26
#: A pivot must stand this far (of the largest distance) from the span of the earlier ones.
_SPREAD = 1e-3
_CHUNK = 8192


class Simplex:
    """The base simplex of some pivots, and the projection onto it."""

    def __init__(self, candidates: np.ndarray) -> None:
        """``candidates``: integer vectors; those too close to the span of earlier ones
        are left out."""
        kept: list[int] = []
        lower = np.zeros((0, 0))
        far = max((float(((candidates - c) ** 2).sum(1).max()) for c in candidates), default=0.0) ** 0.5
        for i, c in enumerate(candidates):
            if not kept:
                kept.append(i)
                continue
            base = candidates[kept]
            apex = _apex(lower, base, c[None])[0]
            if apex[-1] > _SPREAD * far:
                kept.append(i)
                grown = np.zeros((len(kept) - 1,) * 2)
                grown[:-1, :-1] = lower
                grown[-1] = apex
                lower = grown
        self.pivots, self.lower = candidates[kept], lower
        self.weakest = float(np.linalg.svd(lower, compute_uv=False).min()) if len(lower) else 1.0

    def apexes(self, x: np.ndarray) -> np.ndarray:
        return _apex(self.lower, self.pivots, x)

    def bounds(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared lower and upper bounds of the distances between the vectors with
        apexes ``a`` (rows) and ``b`` (columns)."""
        size = (a * a).sum(1)[:, None] + (b * b).sum(1)
        base = ((a[:, None, :-1] - b[:, :-1]) ** 2).sum(2)
        # the heights come from differences of squares: their error is the root of the rounding error
        slack = 1e-5 * size * np.sqrt(1 + np.sqrt(size) / self.weakest) + 1e-6
        low = base + (a[:, None, -1] - b[:, -1]) ** 2 - slack
        high = base + (a[:, None, -1] + b[:, -1]) ** 2 + slack
        return low, high


def _apex(lower: np.ndarray, pivots: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Coordinates in the base spanned by ``lower`` (rows are the pivots but the first,
    which is the origin), and the height, from the distances to the pivots."""
    squared = np.stack([((x - p) ** 2).sum(1) for p in pivots], 1).astype(float)
    inner = (squared[:, :1] - squared[:, 1:] + (lower * lower).sum(1)) / 2
    coordinates = np.zeros_like(inner)
    for i in range(inner.shape[1]):
        coordinates[:, i] = (inner[:, i] - coordinates[:, :i] @ lower[i, :i]) / lower[i, i]
    height = np.sqrt(np.maximum(squared[:, 0] - (coordinates**2).sum(1), 0))
    return np.column_stack([coordinates, height])


def nearest(simplex: Simplex, x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """The nearest centroid of each vector (ties: the smaller number), and how many
    exact distances it took."""
    low, high = simplex.bounds(apexes, simplex.apexes(centroids))
    open_ = low <= high.min(1)[:, None]
    best = np.argmax(open_, 1)
    several = open_.sum(1) > 1
    distance = np.full(len(x), np.iinfo(np.int64).max)
    for j, c in enumerate(centroids):
        rows = np.flatnonzero(several & open_[:, j])
        d = ((x[rows] - c) ** 2).sum(1)
        closer = d < distance[rows]
        rows = rows[closer]
        best[rows], distance[rows] = j, d[closer]
    return best, int(open_[several].sum())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, _CHUNK):
            yield batch.slice(lo, _CHUNK)


def with_apexes(rows: DataFrame, simplex: Simplex, dim: int) -> DataFrame:
    """``rows`` (vec_id, vec array<long>) with their apexes."""
    shared = Shared(rows.sparkSession, simplex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.get()
        for batch in _chunks(batches):
            x = _matrix(batch.column("vec"), dim)
            if x.size and (x.max() > LIMIT or x.min() < -LIMIT):
                raise ValueError(f"a component is beyond {LIMIT} after scaling; its distances do not fit 64 bits")
            a = base.apexes(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), _lists(x.astype(np.int32)), _lists(a)], names=["vec_id", "vec", "apex"]
            )

    return rows.mapInArrow(run, "vec_id long, vec array<int>, apex array<double>")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]).astype(np.int32)), pa.array(x.ravel()))


def _assign(stored: DataFrame, simplex: Simplex, centroids: np.ndarray, dim: int) -> DataFrame:
    """vec_id, cluster and exact squared distance of every vector."""
    shared = Shared(stored.sparkSession, (simplex, centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, middle = shared.get()
        for batch in _chunks(batches):
            x = _matrix(batch.column("vec"), dim).astype(np.int64)
            best, _ = nearest(base, x, _matrix(batch.column("apex"), len(base.pivots)), middle)
            distance = ((x - middle[best]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return stored.mapInArrow(run, "vec_id long, cluster int, distance long")


def _moved(stored: DataFrame, simplex: Simplex, centroids: np.ndarray, dim: int) -> np.ndarray:
    """The centroids after a round."""
    shared = Shared(stored.sparkSession, (simplex, centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, middle = shared.get()
        k = len(middle)
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in _chunks(batches):
            x = _matrix(batch.column("vec"), dim).astype(np.int64)
            best, _ = nearest(base, x, _matrix(batch.column("apex"), len(base.pivots)), middle)
            counts += np.bincount(best, minlength=k)
            for j in range(k):
                sums[j] += x[best == j].sum(0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, dim).astype(np.int32)), pa.array(np.tile(np.arange(dim), len(used)).astype(np.int32)),
                pa.array(sums[used].ravel()), pa.array(np.repeat(counts[used], dim)),
            ],
            names=["cluster", "place", "total", "n"],
        )

    parts = stored.mapInArrow(run, "cluster int, place int, total long, n long")
    out = centroids.copy()
    for row in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[row.cluster, row.place] = row.total // row.n
    return out


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: float = SCALE, dim: int = DIM, seed: str = SEED, pivots: int = PIVOTS
) -> DataFrame:
    """Cluster, squared distance, inertias and the centroid's digest of every vector of
    ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    numbers = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    rows = vectors.filter(finite(F.col("embedding")) & (F.size("embedding") == dim)).select(
        F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("vec")
    )
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    start = rows.orderBy(key.asc_nulls_last(), "vec").limit(max(k, pivots)).collect()
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    first = np.array([r.vec for r in start], np.int64)
    if np.abs(first).max() > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT} after scaling; its distances do not fit 64 bits")
    simplex = Simplex(first[:pivots])
    stored = stage(with_apexes(rows, simplex, dim), "apexes")
    centroids = first[:k]
    for _ in range(rounds):
        moved = _moved(stored, simplex, centroids, dim)
        if (moved == centroids).all():  # nothing will move any more
            break
        centroids = moved
    found = stage(_assign(stored, simplex, centroids, dim), "clusters")
    inertia = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    number = F.col("cluster") + 1
    return found.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*(F.lit(inertia.get(j, 0)).cast("long") for j in range(len(digests)))), number).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), number).alias("centroid_sha256"),
    )
