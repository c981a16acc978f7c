"""Linear classifiers on hashed words and text shape, fitted on a bounded sample.

The sample is the labelled rows with the smallest hash of their id (``max_rows`` at
most). Document frequencies and the choice of word features are Spark aggregations
over the sample; only the sample's chosen features reach the driver, where penalised
logistic regressions are fitted. Prediction runs over all documents in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.llm.textops import BLANK, MARK, WINDOW, buffers, doc_of, slices, words
from bazaarcube.session import stage

#: Labelled rows used for fitting at most.
MAX_ROWS = 20_000
#: Word features chosen for each label.
WORD_FEATURES = 2048
#: A word feature must occur in so many documents of the sample.
MIN_DOCS = 5
BUCKET_BITS = 20
FOLDS = 5
#: Ridge penalties. Words are rare and telling; shape must earn its weight.
WORD_PENALTY, SHAPE_PENALTY = 0.1, 20.0
#: Words whose chi-squared statistic with a label is smaller are no features for it.
MIN_CHI = 8.0

_CLASS = np.full(256, 5, np.uint8)  # other signs
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[BLANK] = 3
_CLASS[10] = 4
_CLASS[128:] = 6
N_CLASSES = 7
#: Shares of the byte classes, letters per word, number of words.
N_SHAPE = N_CLASSES + 2


def word_buckets(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash bucket and document of each word, and the number of words by document."""
    h, first = words(text, MARK)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), doc_of(first), np.diff(first)


def shape(text: pa.Array, n_words: np.ndarray) -> np.ndarray:
    data, offsets = buffers(text)
    n = len(offsets) - 1
    counts = np.zeros(n * N_CLASSES)
    for at in range(0, len(data), WINDOW):
        to = min(at + WINDOW, len(data))
        lo, hi = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, to, "left")
        doc = np.repeat(np.arange(lo, hi), np.diff(np.clip(offsets[lo : hi + 1], at, to)))
        found = np.bincount((doc - lo) * N_CLASSES + _CLASS[data[at:to]], minlength=(hi - lo) * N_CLASSES)
        counts[lo * N_CLASSES : hi * N_CLASSES] += found
    counts = counts.reshape(n, N_CLASSES)
    total = counts.sum(1)
    shares = counts / np.maximum(total, 1)[:, None]
    letters = (counts[:, 0] + counts[:, 1] + counts[:, 6]) / np.maximum(n_words, 1)
    return np.column_stack([shares, np.log1p(letters), np.log1p(n_words)])


@dataclass
class Sample:
    """Features and labels of the sampled rows; a label is NaN where it is unknown."""

    indptr: np.ndarray
    columns: np.ndarray
    dense: np.ndarray
    labels: np.ndarray
    fold: np.ndarray

    def rows(self, pick: np.ndarray) -> Sample:
        n = np.diff(self.indptr)[pick]
        at = np.repeat(self.indptr[:-1][pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return Sample(np.concatenate([[0], np.cumsum(n)]), self.columns[at], self.dense[pick], self.labels[pick], self.fold[pick])


@dataclass
class Features:
    """The chosen word buckets and the scale of the shape features."""

    chosen: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def lookup(self) -> np.ndarray:
        table = np.full(1 << BUCKET_BITS, -1, np.int32)
        table[self.chosen] = np.arange(len(self.chosen))
        return table

    def of(self, text: pa.Array, lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """indptr, columns and dense features of each text."""
        bucket, doc, n_words = word_buckets(text)
        column = lookup[bucket]
        hit = column >= 0
        width = len(self.chosen) + 1
        key = np.unique(doc[hit] * width + column[hit])
        indptr = np.searchsorted(key, np.arange(len(n_words) + 1) * width)
        return indptr, key % width, (shape(text, n_words) - self.mean) / self.scale


def sample(docs: DataFrame, labels: DataFrame, names: list[str], max_rows: int = MAX_ROWS, word_features: int = WORD_FEATURES) -> tuple[Features, Sample]:
    """``labels``: doc_id and a 0/1 column for each of ``names``; of repeated rows the
    largest value counts. Rows without an id or without any label are ignored; of
    repeated documents one counts."""
    spark = docs.sparkSession
    picked = (
        labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*(F.max(n).cast("double").alias(n) for n in names))
        .filter(F.coalesce(*names).isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = batch.column("text")
            bucket, doc, n_words = word_buckets(text)
            key = np.unique(doc << BUCKET_BITS | bucket)
            indptr = np.searchsorted(key, np.arange(len(text) + 1) << BUCKET_BITS).astype(np.int32)
            buckets = pa.ListArray.from_arrays(pa.array(indptr), pa.array((key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)))
            dense = shape(text, n_words)
            at = np.arange(0, dense.size + 1, N_SHAPE).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(n) for n in names), buckets, pa.ListArray.from_arrays(pa.array(at), pa.array(dense.ravel()))],
                names=["doc_id", *names, "buckets", "shape"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    typed = ", ".join(f"{n} double" for n in names)
    found = rows.mapInArrow(featurise, f"doc_id {kind}, {typed}, buckets array<int>, shape array<double>")
    one = found.groupBy("doc_id", *names).agg(F.min(F.struct("shape", "buckets")).alias("x"))
    stored = stage(one.select("doc_id", *names, "x.buckets", "x.shape"), "labelled")
    n_all, *n_label = stored.agg(F.count("*"), *(F.count(n) for n in names), *(F.coalesce(F.sum(n), F.lit(0.0)) for n in names)).first()
    with_label, ones = n_label[: len(names)], n_label[len(names) :]
    by_bucket = stage(
        stored.select(*names, F.explode("buckets").alias("bucket")).groupBy("bucket")
        .agg(F.count("*").alias("n"), *(F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names))
        .filter(F.col("n") >= MIN_DOCS),
        "buckets",
    )
    chosen: set[int] = set()
    for name, n_c, one_c in zip(names, with_label, ones, strict=True):
        if 0 < one_c < n_c:
            n, k = F.col("n").cast("double"), F.col(name)
            chi = (k * F.lit(float(n_c)) - n * F.lit(float(one_c))) ** 2 / (n * F.greatest(F.lit(float(n_all)) - n, F.lit(1.0)))
            chi = chi * F.lit(float(n_all) / (one_c * (n_c - one_c)))
            top = by_bucket.select("bucket", chi.alias("chi")).filter(F.col("chi") >= MIN_CHI).orderBy(F.desc("chi"), "bucket").limit(word_features)
            chosen |= {row.bucket for row in top.collect()}
    picked_buckets = np.array(sorted(chosen), np.int64)
    features = Features(picked_buckets, np.zeros(N_SHAPE), np.ones(N_SHAPE))
    lookup = features.lookup()

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            column = lookup[values]
            before = np.concatenate([[0], np.cumsum(column >= 0)])
            kept = pa.ListArray.from_arrays(pa.array(before[at].astype(np.int32)), pa.array(column[column >= 0]))
            yield batch.set_column(batch.schema.get_field_index("buckets"), "buckets", kept)

    table = stored.mapInArrow(reduce, stored.schema).orderBy(F.xxhash64("doc_id"), "doc_id").select("*", (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(FOLDS))).alias("fold")).toArrow()
    lists = table.column("buckets").combine_chunks()
    n = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    dense = np.array(table.column("shape").to_pylist(), float).reshape(-1, N_SHAPE)
    y = np.column_stack([table.column(name).to_numpy().astype(float) for name in names]) if len(n) else np.zeros((0, len(names)))
    if len(dense):
        features.mean, features.scale = dense.mean(0), np.maximum(dense.std(0), 1e-9)
    flat = lists.flatten().to_numpy() if len(lists) else np.zeros(0, np.int32)
    data = Sample(np.concatenate([[0], np.cumsum(n)]).astype(np.int64), flat.astype(np.int64), (dense - features.mean) / features.scale, y, table.column("fold").to_numpy())
    return features, data


@dataclass
class Linear:
    """Weights of the word features, of the dense features, and the intercept."""

    sparse: np.ndarray
    dense: np.ndarray
    bias: float

    def logits(self, indptr: np.ndarray, columns: np.ndarray, dense: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
        return np.bincount(row, self.sparse[columns], len(indptr) - 1) + dense @ self.dense + self.bias


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(data: Sample, y: np.ndarray, dense: np.ndarray, n_sparse: int, steps: int = 10, inner: int = 15) -> Linear:
    """Penalised logistic regression by Newton steps, each solved by conjugate gradients."""
    n = len(y)
    row = np.repeat(np.arange(n), np.diff(data.indptr))
    m = dense.shape[1]
    ones = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    w = np.zeros(n_sparse + m + 1)
    w[-1] = np.log(ones / (1 - ones))
    if n == 0 or y.min() == y.max():
        return Linear(w[:n_sparse], w[n_sparse:-1], float(w[-1]))
    weight = np.full(len(w), SHAPE_PENALTY)
    weight[:n_sparse], weight[n_sparse + N_SHAPE : -1], weight[-1] = WORD_PENALTY, 1.0, 1e-6

    def forward(v: np.ndarray) -> np.ndarray:
        return np.bincount(row, v[:n_sparse][data.columns], n) + dense @ v[n_sparse:-1] + v[-1]

    def backward(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(data.columns, r[row], n_sparse)[:n_sparse], dense.T @ r, [r.sum()]])

    def loss(v: np.ndarray) -> float:
        z = forward(v)
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * (weight * v * v).sum())

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(forward(w))
        gradient = backward(p - y) + weight * w
        h = p * (1 - p) + 1e-9
        scale = 1 / (weight + backward(h) + 1e-9)
        step, r = np.zeros_like(w), -gradient
        z = scale * r
        d, rz = z.copy(), r @ z
        for _ in range(inner):
            hd = backward(h * forward(d)) + weight * d
            a = rz / max(d @ hd, 1e-30)
            step, r = step + a * d, r - a * hd
            z = scale * r
            rz, old = r @ z, rz
            if rz < 1e-8 * max(old, 1e-30):
                break
            d = z + rz / old * d
        size = 1.0
        while size > 1e-3 and (new := loss(w + size * step)) > now:
            size /= 2
        if size <= 1e-3:
            break
        gained = now - new
        w, now = w + size * step, new
        if gained < 1e-6 * max(1.0, abs(now)):
            break
    return Linear(w[:n_sparse], w[n_sparse:-1], float(w[-1]))
