"""Mixing to target weights with soft domain membership.

A classifier fitted on the labelled table gives every document a posterior over
domains. Document rates r >= 0 are fitted so that the expected tokens of each domain,
sum over documents of rate x tokens x posterior, match target weight x tokens wanted: least
squares in the domain totals by projected gradient. The gradient has one entry per
domain, so a document's step needs only its posterior: r <- max(0, r - posterior . v).
With v taken from the residual before the step, steps must be short and the fit crawls
where many rates sit at their bound. Here v is the residual after the step (an implicit
step, stable at any length): v solves as many equations as there are domains, by Newton
steps with a line search. Each of these is one pass over the posteriors, in which a task
gives a few sums for each trial. Steps of growing length go on until the targets are met
or no rate can move to a smaller residual (the projected gradient), to within
``TOLERANCE`` of the tokens; a fit that does not get there in ``MAX_STEPS`` raises.

A rate says how often a document is seen on average. Applied to documents it becomes
copies: the whole part, and one more with the probability of the rest, decided by a
hash of the row, so the result does not depend on the run.

Rates may have a lower bound (``least``). Where all documents are to stay it is 1, and
``epochs`` then counts from the smallest mix that has both every document and the
target shares: the tokens there are, times the largest ratio of a domain's share to its
target. A domain above its target thus makes the others be repeated more.

Defined cases: null or wordless texts have no tokens; they keep rate 1 and one row. With no
labels every document belongs to all domains equally. Targets that cannot be met give
the totals of the least-squares optimum. Repeated rows are separate rows;
extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.llm import linear
from bazaarcube.llm.tables import Shared, extended, fresh_names
from bazaarcube.llm.textops import slices, words
from bazaarcube.session import stage

#: Share of the tokens each domain is to have.
TARGETS = {"high": 0.80, "low": 0.15, "toxic": 0.05}
#: More steps are an error; a fit takes a few.
MAX_STEPS = 100
TOLERANCE = 1e-9
#: Newton steps for one implicit step, and the sizes tried at a time.
_NEWTON, _SIZES = 40, (1.0, 0.5, 0.25, 0.1, 0.03, 0.01)


@dataclass
class Domains:
    names: list[str]
    features: linear.Features
    models: list[linear.Linear]

    def prepare(self) -> Domains:
        self.lookup = self.features.lookup()
        return self

    def posteriors(self, text: pa.Array) -> np.ndarray:
        indptr, columns, dense = self.features.of(text, self.lookup)
        p = np.column_stack([linear.sigmoid(m.logits(indptr, columns, dense)) for m in self.models])
        return p / p.sum(1, keepdims=True)


def domain_labels(labels: DataFrame) -> DataFrame:
    """Domains of the table ``labels``: toxic, else high or low by quality."""
    toxic, quality = F.col("toxic") == 1, F.col("quality")
    clean = F.coalesce(F.col("toxic") != 1, F.lit(True))
    return labels.filter(toxic | quality.isNotNull()).select(
        "doc_id",
        F.coalesce(clean & (quality == 1), F.lit(False)).cast("int").alias("high"),
        F.coalesce(clean & (quality == 0), F.lit(False)).cast("int").alias("low"),
        F.coalesce(toxic, F.lit(False)).cast("int").alias("toxic"),
    )


def fit_domains(docs: DataFrame, labels: DataFrame, names: list[str], max_rows: int = linear.MAX_ROWS) -> Domains:
    """``labels``: doc_id and a 0/1 column for each domain."""
    features, data = linear.sample(docs, labels, names, max_rows)
    models = []
    for k in range(len(names)):
        y = data.labels[:, k]
        known = ~np.isnan(y)
        models.append(linear.fit(data.rows(known), y[known], data.dense[known], len(features.chosen)))
    return Domains(names, features, models)


def rates_of(p: np.ndarray, steps: list[np.ndarray], least: float) -> np.ndarray:
    """The rates of documents with posteriors ``p`` after ``steps`` from rate 1."""
    rate = np.full(len(p), max(1.0, least))
    for v in steps:
        rate = np.maximum(least, rate - p @ v)
    return rate


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])


def with_posteriors(
    docs: DataFrame, domains: Domains, steps: list[np.ndarray] | None = None, least: float = 0.0
) -> tuple[DataFrame, str, list[str], str]:
    """``docs`` with its number of tokens, a posterior column for each domain, and the
    rate after ``steps``."""
    shared = Shared(docs.sparkSession, domains, Domains.prepare)
    tokens, rate, *p_names = fresh_names(docs, ["n_tokens", "rate"] + [f"p_{n}" for n in domains.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = shared.get()
        for batch in slices(batches):
            text = batch.column("text")
            p = ready.posteriors(text)
            n = np.diff(words(text)[1]).astype(np.int64)
            r = np.where(n > 0, rates_of(p, steps or [], least), 1.0)
            added = [pa.array(n)] + [pa.array(p[:, k]) for k in range(p.shape[1])] + [pa.array(r)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, tokens, *p_names, rate])

    schema = extended(docs, **{tokens: "long"}, **dict.fromkeys(p_names, "double"), **{rate: "double"})
    return docs.mapInArrow(run, schema), tokens, p_names, rate


def _summed(found: DataFrame, columns: list[str], sums: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """The sum over all batches of ``sums``, which gives ``width`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += sums(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["place", "x"])

    out = np.zeros(width)
    for row in found.select(*columns).mapInArrow(run, "place long, x double").groupBy("place").agg(F.sum("x").alias("x")).collect():
        out[row.place] = row.x
    return out


@dataclass
class Fit:
    """The steps from rate 1, what the domain totals miss of their targets, and how far
    the projected gradient is from zero (both as shares of the tokens)."""

    steps: list[np.ndarray]
    residual: np.ndarray
    gradient: float


def fit_rates(
    found: DataFrame, tokens: str, p_names: list[str], weights: list[float], epochs: float = 1.0, least: float = 0.0
) -> Fit:
    """The steps from rate 1 to the fitted rates, of which none is below ``least``.
    ``epochs``: tokens wanted for each token there is, or with ``least`` for each token
    of the smallest mix that holds ``least`` of every document at the targets."""
    k, columns = len(p_names), [tokens, *p_names]

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return _matrix(batch, p_names), batch.column(tokens).to_numpy().astype(float)

    def first(batch: pa.RecordBatch) -> np.ndarray:
        p, t = read(batch)
        return np.concatenate([[t.sum()], t @ p, ((p * t[:, None]).T @ p).ravel()])

    x = _summed(found, columns, first, 1 + k + k * k)
    total = float(x[0])
    if total <= 0:
        return Fit([], np.zeros(k), 0.0)
    own, size = x[1 : 1 + k] / total, float(np.trace(x[1 + k :].reshape(k, k))) / total
    share = np.array(weights) / sum(weights)
    target = share * epochs
    if least:
        wanted = share > 0
        target = target * (own[wanted] * least / share[wanted]).max()

    def evaluate(steps: list[np.ndarray], trials: list[np.ndarray], d: float) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each trial v after ``steps``, the value, gradient and curvature of the
        function that the residual after the step, divided by ``d``, minimises."""

        def sums(batch: pa.RecordBatch) -> np.ndarray:
            p, t = read(batch)
            t, rate, out = t / total, rates_of(p, steps, least), []
            for v in trials:
                new = rate - p @ v
                free = new >= least
                value = np.where(free, new * new / 2, least * new - least * least / 2)
                out += [[t @ value], (t * np.maximum(least, new)) @ p, ((p * (t * free)[:, None]).T @ p).ravel()]
            return np.concatenate(out)

        width = 1 + k + k * k
        found_ = _summed(found, columns, sums, width * len(trials)).reshape(-1, width)
        return [
            (d / 2 * v @ v + target @ v + row[0], d * v + target - row[1 : 1 + k], d * np.eye(k) + row[1 + k :].reshape(k, k))
            for v, row in zip(trials, found_, strict=True)
        ]

    def projected(steps: list[np.ndarray], residual: np.ndarray) -> float:
        def sums(batch: pa.RecordBatch) -> np.ndarray:
            p, t = read(batch)
            rate = rates_of(p, steps, least)
            return np.array([t / total @ np.abs(rate - np.maximum(least, rate - p @ residual))])

        return float(_summed(found, columns, sums, 1)[0])

    steps: list[np.ndarray] = []
    residual = own * max(1.0, least) - target
    for i in range(MAX_STEPS + 1):
        gradient = projected(steps, residual)
        if np.abs(residual).max() <= TOLERANCE or gradient <= TOLERANCE:
            return Fit(steps, residual, gradient)
        if i == MAX_STEPS:
            break
        d = size / k * 10.0 ** -min(3 + 2 * i, 8)
        v = np.zeros(k)
        value, slope, curve = evaluate(steps, [v], d)[0]
        for _ in range(_NEWTON):
            if np.abs(slope).max() <= 1e-13 * max(1.0, np.abs(target).max()):
                break
            newton = np.linalg.solve(curve, slope)
            trials = [v - a * newton for a in _SIZES] + [v - slope / (size + d)]
            after = evaluate(steps, trials, d)
            best = min(range(len(trials)), key=lambda j: after[j][0])
            if after[best][0] >= value and np.abs(after[best][1]).max() >= np.abs(slope).max():
                break  # as close as the numbers allow
            v, (value, slope, curve) = trials[best], after[best]
        steps = [*steps, v]
        residual = d * v - slope  # slope = d v - residual
    raise RuntimeError(f"the rates have not converged: residual {residual}, projected gradient {gradient}")


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, epochs: float = 1.0, least: float = 0.0) -> DataFrame:
    """doc_id, tokens, posteriors and the fitted rate of every document."""
    names = list(targets)
    domains = fit_domains(docs, labels, names)
    found, tokens, p_names, rate = with_posteriors(docs.select("doc_id", "text"), domains)
    stored = stage(found.drop("text", rate), "posteriors")
    fit = fit_rates(stored, tokens, p_names, list(targets.values()), epochs, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = np.where(batch.column(tokens).to_numpy() > 0, rates_of(_matrix(batch, p_names), fit.steps, least), 1.0)
            yield batch.append_column("rate", pa.array(r))

    return stored.mapInArrow(run, extended(stored, rate="double"))


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, epochs: float = 1.0, least: float = 0.0
) -> DataFrame:
    """Documents repeated or left out by their fitted rate, with their own columns. With
    ``least`` of 1 no document is left out."""
    domains = fit_domains(docs, labels, list(targets))
    found, tokens, p_names, rate = with_posteriors(docs.select("doc_id", "text"), domains)
    stored = stage(found.drop("text", rate), "posteriors")
    fit = fit_rates(stored, tokens, p_names, list(targets.values()), epochs, least)
    found, _, _, name = with_posteriors(docs, domains, fit.steps, least)
    rate = F.col(name)
    chance = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    (n,) = fresh_names(found, ["copies"])
    out = found.withColumn(n, F.explode(F.array_repeat(F.lit(1), copies)))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
