"""Packing documents into batches of one padded length.

The histogram of lengths over all documents goes to the driver: one row for each
distinct length, of which there are fewer than the root of twice the tokens. There
dynamic programming chooses the upper bounds of the buckets so that padding is minimal. Every document goes to the first bucket that holds it. In a
bucket, documents are dealt by hash into groups of about ``GROUP`` rows, so that a
bucket with any share of all rows is split, and a group is cut into batches whose
padded tokens stay within the budget. A document longer than the budget is a batch of
its own.

Defined cases: null and wordless texts have length 0 and form a bucket like any other
length; equal lengths and repeated rows take neighbouring places; without documents
there are no buckets. The id is only carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarcube.llm.textops import slices, words
from bazaarcube.session import stage

BUCKETS = 16
#: Padded tokens of a batch.
BUDGET = 65_536
#: Rows of a group on average.
GROUP = 50_000


def lengths(docs: DataFrame) -> DataFrame:
    """doc_id, number of blank-separated words, and a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = np.diff(words(batch.column("text"))[1]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), batch.column("hash")], names=["doc_id", "n_tokens", "hash"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).mapInArrow(run, f"doc_id {kind}, n_tokens long, hash long")


def histogram(found: DataFrame) -> list[tuple[int, int, int]]:
    """(length, documents, tokens) of each distinct length, in order."""
    rows = found.groupBy(F.col("n_tokens").alias("top")).agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))
    return sorted((r.top, r.docs, r.tokens) for r in rows.collect())


def best_bounds(bins: list[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding. The best cut
    before a bin never moves back as the bin moves on, so each half of the bins needs
    only its side of the cut in the middle: n log n steps for each bucket."""
    if not bins:
        return []
    top, docs, tokens = (np.array(x, np.float64) for x in zip(*bins, strict=True))
    n = len(bins)
    d, t = np.concatenate([[0], np.cumsum(docs)]), np.concatenate([[0], np.cumsum(tokens)])
    cost = np.full(n + 1, np.inf)
    cost[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0
        parts = [(1, n, 0, n - 1)]
        while parts:
            low, high, first, last = parts.pop()
            if low > high:
                continue
            j = (low + high) // 2  # the bucket of bins i to j - 1
            i = slice(first, min(last, j - 1) + 1)
            each = cost[i] + top[j - 1] * (d[j] - d[i]) - (t[j] - t[i])
            cut[j] = first + int(np.argmin(each))
            new[j] = each[cut[j] - first]
            parts += [(low, j - 1, first, int(cut[j])), (j + 1, high, int(cut[j]), last)]
        cost = new
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(top[j - 1]))
        j = int(cut[j])
    return sorted(bounds)


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, group: int = GROUP) -> DataFrame:
    """doc_id, n_tokens, bucket (from 0), padded_length, batch_id and position in it."""
    found = stage(lengths(docs), "lengths")
    bins = histogram(found)
    bounds = best_bounds(bins, buckets)
    if not bounds:
        bounds = [0]
    per = [sum(n for top, n, _ in bins if low < top <= high) for low, high in zip([-1, *bounds[:-1]], bounds, strict=True)]
    n = F.col("n_tokens")
    bucket = F.coalesce(*(F.when(n <= F.lit(b), F.lit(i)) for i, b in enumerate(bounds)))
    at = F.col("bucket") + 1
    groups = F.element_at(F.array(*(F.lit(max(1, -(-p // group))) for p in per)), at)
    capacity = F.element_at(F.array(*(F.lit(max(1, budget // max(b, 1))) for b in bounds)), at)
    spread = F.pmod(F.xxhash64("doc_id", "hash"), groups)
    order = Window.partitionBy("bucket", "group").orderBy("n_tokens", "doc_id", "hash")
    place = F.row_number().over(order) - 1
    return (
        found.withColumn("bucket", bucket)
        .withColumn("group", spread)
        .withColumn("place", place)
        .select(
            "doc_id",
            "n_tokens",
            "bucket",
            F.element_at(F.array(*(F.lit(b).cast("long") for b in bounds)), at).alias("padded_length"),
            F.concat_ws("-", "bucket", "group", F.floor(F.col("place") / capacity)).alias("batch_id"),
            (F.col("place") % capacity).cast("int").alias("position"),
        )
    )
