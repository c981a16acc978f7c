"""Exact top-k by inner product with Fagin's threshold algorithm.

The vectors are packed into blocks as the tasks read them, the queries likewise. A
block of vectors meets a block of queries in one row of an equi-join; there the block
is sorted once for each dimension, and for each query these lists are read from the
end that its weight favours, some entries at a time. New vectors are scored in full;
reading stops as soon as the k-th best score exceeds the bound, the score that the
next entries of all lists could reach at most. The best k of all blocks are merged.

Components are integers, floor(scale x component). Ties go to the smaller id.
Defined cases: vectors that are null, empty or hold null or non-finite components take
no part, nor do rows without an id; vectors of different lengths do not meet; rows
with the query's own id are its own row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarcube.session import stage

K = 5
SCALE = 256.0
QUERY_EVERY = 50
#: Rows of a block.
BLOCK = 4096
#: Entries read from every list before the first look at the bound.
FIRST_DEPTH = 16


def finite(vector: Column) -> Column:
    """Not null, not empty, and all components finite numbers."""
    good = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & good


def pack(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks (block, dim, n, ids, values) of ``rows`` (vec_id long, vec array<long>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        number = TaskContext.get().partitionId() << 32

        def out(dim: int, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([dim]), pa.array([len(ids)]), pa.array([ids.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())],
                names=["block", "dim", "n", "ids", "values"],
            )

        for batch in batches:
            lists, ids = batch.column("vec"), batch.column("vec_id").to_numpy()
            sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for dim in np.unique(sizes):
                rows_of = np.flatnonzero(sizes == dim)
                values = flat[starts[rows_of][:, None] + np.arange(dim)]
                waiting.setdefault(int(dim), []).append((ids[rows_of], values))
                if sum(len(i) for i, _ in waiting[int(dim)]) >= block:
                    i, v = (np.concatenate(x) for x in zip(*waiting[int(dim)], strict=True))
                    full = len(i) // block * block
                    for lo in range(0, full, block):
                        yield out(int(dim), i[lo : lo + block], v[lo : lo + block])
                    waiting[int(dim)] = [(i[full:], v[full:])]
        for dim, parts in waiting.items():
            i, v = (np.concatenate(x) for x in zip(*parts, strict=True))
            if len(i):
                yield out(dim, i, v)

    return rows.mapInArrow(run, "block long, dim long, n long, ids binary, values binary")


def threshold_topk(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its id, and ids and scores of its best k among ``x``."""
    n, dim = x.shape
    limit = float(np.abs(x).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dim
    kind = np.float64 if limit < 2**53 else np.int64  # float sums of integers are exact below 2**53
    order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
    ranked = np.take_along_axis(x, order, 0).astype(kind)
    rising, falling = order, order[::-1]
    low, high = ranked, ranked[::-1]
    x = x.astype(kind)
    for query_id, raw in zip(query_ids, queries, strict=True):
        q = raw.astype(kind)
        up, used = q > 0, np.flatnonzero(q)
        seen = ids == query_id
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, kind)
        depth, step = 0, FIRST_DEPTH
        while True:
            to = min(depth + step, n)
            if len(used):
                rows = np.concatenate([falling[depth:to, up].ravel(), rising[depth:to, q < 0].ravel()])
            else:  # all scores are 0
                rows, to = np.arange(n), n
            fresh = np.zeros(n, bool)
            fresh[rows] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh)
            best_ids, best = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, x[rows] @ q])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            if to == n:
                break
            bound = (np.where(up, high[to - 1], low[to - 1]) * q).sum()
            if len(best) == k and best[-1] > bound:
                break
            depth, step = to, step * 2
        yield int(query_id), best_ids, best.astype(np.int64)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim = batch.column("dim")[row].as_py()
                ids, values, q_ids, q_values = (
                    np.frombuffer(batch.column(name)[row].as_buffer(), np.int64) for name in ("ids", "values", "q_ids", "q_values")
                )
                found = list(threshold_topk(ids, values.reshape(-1, dim), q_ids, q_values.reshape(-1, dim), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]).astype(np.int64)),
                        pa.array(np.concatenate([i for _, i, _ in found])),
                        pa.array(np.concatenate([s for _, _, s in found])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best vectors for each query.
    ``vectors``: vec_id and embedding; ``is_query``: condition on them."""
    numbers = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("vec"), is_query.alias("asked")
    )
    data = stage(pack(rows.select("vec_id", "vec")), "blocks")
    asked = stage(pack(rows.filter("asked").select("vec_id", "vec").dropDuplicates()), "queries")
    n_data = max(1, -(-(data.agg(F.sum("n")).first()[0] or 0) // BLOCK))
    n_asked = max(1, -(-(asked.agg(F.sum("n")).first()[0] or 0) // BLOCK))
    # every pair of a vector place and a query place is one key, so pairs spread evenly
    here = data.withColumn("place", F.pmod(F.xxhash64("block"), F.lit(n_data)).cast("int")).withColumn("q_place", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
    there = asked.select("dim", F.col("ids").alias("q_ids"), F.col("values").alias("q_values"), F.pmod(F.xxhash64("block"), F.lit(n_asked)).cast("int").alias("q_place"))
    there = there.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(n_data - 1))))
    pairs = here.join(there.hint("shuffle_hash"), ["place", "q_place", "dim"]).select("dim", "ids", "values", "q_ids", "q_values")
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
