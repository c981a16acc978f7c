"""Toxicity by a classifier chain.

The categories are predicted one after the other; each model sees the words, the
shape of the text, and the log-odds that the models of the earlier categories give.
For fitting, those log-odds are out-of-fold (the model that gave them has not seen the
row), so later models learn how far earlier ones can be trusted. The last category
decides; its threshold is the one with the best F1 on out-of-fold predictions, at
least 0.5.

Defined cases: a null text is empty and gets the probability of an empty text; a
category without both values among the labels is predicted by its base rate, and if
this is the last one nothing is rejected; rows without an id, repeated rows and extra
columns are scored and kept like any other. Rejection does not look at the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.llm import linear
from bazaarcube.llm.tables import Shared, extended, fresh_names
from bazaarcube.llm.textops import slices

#: Earlier category first; each is a 0/1 column of the labels.
CATEGORIES = ["low_quality", "toxic"]


@dataclass
class Chain:
    categories: list[str]
    features: linear.Features
    models: list[linear.Linear]
    threshold: float

    def prepare(self) -> Chain:
        self.lookup = self.features.lookup()
        return self

    def probabilities(self, text: pa.Array) -> np.ndarray:
        """A column for each category."""
        indptr, columns, dense = self.features.of(text, self.lookup)
        logits = np.zeros((len(text), 0))
        for model in self.models:
            z = model.logits(indptr, columns, np.column_stack([dense, logits]))
            logits = np.column_stack([logits, np.clip(z, -20, 20)])
        return linear.sigmoid(logits)


def best_threshold(y: np.ndarray, p: np.ndarray) -> float:
    """The cut with the best F1, in the middle of its gap."""
    if not len(y) or y.min() == y.max():
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    below = np.append(p[order][1:], 0.0)
    f1[p[order] == below] = -1  # no cut between equal values
    at = int(np.argmax(f1))
    return max(0.5, float((p[order][at] + below[at]) / 2))


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows: int = linear.MAX_ROWS) -> Chain:
    features, data = linear.sample(docs, labels, categories, max_rows)
    n_sparse, earlier, models = len(features.chosen), np.zeros((len(data.fold), 0)), []
    threshold = 2.0
    for k in range(len(categories)):
        y = data.labels[:, k]
        known = ~np.isnan(y)
        dense = np.column_stack([data.dense, earlier])
        out = np.zeros(len(y))
        for fold in range(linear.FOLDS):
            rows = known & (data.fold != fold)
            model = linear.fit(data.rows(rows), y[rows], dense[rows], n_sparse)
            test = data.fold == fold
            part = data.rows(test)
            out[test] = model.logits(part.indptr, part.columns, dense[test])
        models.append(linear.fit(data.rows(known), y[known], dense[known], n_sparse))
        earlier = np.column_stack([earlier, np.clip(out, -20, 20)])
        threshold = best_threshold(y[known], linear.sigmoid(earlier[known, -1]))
    return Chain(categories, features, models, threshold)


def label_columns(labels: DataFrame) -> DataFrame:
    """The categories from the table ``labels`` (quality 0/1, toxic 0/1)."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def predict(docs: DataFrame, chain: Chain) -> tuple[DataFrame, list[str], str]:
    """``docs`` with a probability column for each category and a column that says
    whether the document is rejected; also the names of these columns."""
    shared = Shared(docs.sparkSession, chain, Chain.prepare)
    *p_names, rejected = fresh_names(docs, [f"p_{c}" for c in chain.categories] + ["rejected"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = shared.get()
        for batch in slices(batches):
            p = ready.probabilities(batch.column("text"))
            added = [pa.array(p[:, k]) for k in range(p.shape[1])] + [pa.array(p[:, -1] >= ready.threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *p_names, rejected])

    schema = extended(docs, **dict.fromkeys(p_names, "double"), **{rejected: "boolean"})
    return docs.mapInArrow(run, schema), p_names, rejected


def keep_clean(docs: DataFrame, chain: Chain) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    found, _, rejected = predict(docs, chain)
    return found.filter(~F.col(rejected)).select(*(F.col(f"`{c}`") for c in docs.columns))
