from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarcube.llm import linear, mixing, toxicity
from bazaarcube.session import stage

BAD = ["zounds", "fiddle", "blast"]


def corpus(spark, n=1200, seed=1):
    """Clean, noisy and abusive documents; two thirds of them are labelled."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 80))]
        low, bad = i % 5 == 1, i % 7 == 2
        if low:
            words = [w.upper() + "!!" for w in words]
        if bad:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(BAD).title() + ","
        docs.append((i, " ".join(words), i, bad))
        if i % 3:
            labels.append((i, int(not low), int(bad)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, p_toxic long, bad boolean"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_the_chain_finds_abuse_and_leaves_clean_documents(spark):
    docs, labels = corpus(spark)
    chain = toxicity.fit(docs, toxicity.label_columns(labels), toxicity.CATEGORIES)
    found, names, rejected = toxicity.predict(docs, chain)
    assert names == ["p_low_quality", "p_toxic_"] and rejected == "rejected"
    rows = found.collect()
    wrong = sum(r.rejected != r.bad for r in rows if r.doc_id % 3 == 0)  # not labelled
    assert wrong <= 0.01 * len(rows)
    kept = toxicity.keep_clean(docs, chain)
    assert kept.columns == docs.columns
    assert kept.filter("not bad").count() >= 0.99 * docs.filter("not bad").count()


def test_later_models_see_earlier_categories(spark):
    docs, labels = corpus(spark, 400)
    chain = toxicity.fit(docs, toxicity.label_columns(labels), toxicity.CATEGORIES)
    assert len(chain.models[1].dense) == len(chain.models[0].dense) + 1
    assert len(chain.models[0].dense) == linear.N_SHAPE


def test_awkward_documents_and_labels(spark, awkward, no_docs, no_labels):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 0, None), (None, 1, 1), (3, None, None), (99, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, no_labels):
        chain = toxicity.fit(awkward, toxicity.label_columns(given), toxicity.CATEGORIES)
        found, names, rejected = toxicity.predict(awkward, chain)
        rows = found.collect()
        assert rejected == "rejected_" and len(rows) == awkward.count()
        assert all(0 <= r[n] <= 1 for r in rows for n in names)
        assert toxicity.predict(no_docs, chain)[0].count() == 0
    assert toxicity.keep_clean(awkward, chain).count() == awkward.count()  # nothing was learned
    toxicity.fit(no_docs, toxicity.label_columns(labels), toxicity.CATEGORIES)


def test_logistic_regression_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, linear.N_SHAPE))
    y = (rng.random(500) < linear.sigmoid(x[:, 0] * 2 - 1)).astype(float)
    data = linear.Sample(np.zeros(501, np.int64), np.zeros(0, np.int64), x, y[:, None], np.zeros(500))
    model = linear.fit(data, y, x, 3, steps=50, inner=50)
    p = linear.sigmoid(model.logits(data.indptr, data.columns, x))
    assert np.abs(x.T @ (p - y) + linear.SHAPE_PENALTY * model.dense).max() < 1e-2
    assert abs((p - y).sum()) < 1e-2


def test_threshold_is_in_the_gap():
    assert toxicity.best_threshold(np.array([0, 0, 1, 1.0]), np.array([0.1, 0.5, 0.7, 0.9])) == pytest.approx(0.6)
    assert toxicity.best_threshold(np.array([0, 0.0]), np.array([0.1, 0.9])) > 1


def totals(found, names):
    p = [F.col(f"p_{n}") for n in names]
    row = found.agg(F.sum("n_tokens"), *(F.sum(F.col("rate") * F.col("n_tokens") * x) for x in p)).first()
    return row[0], np.array(row[1:])


@pytest.mark.parametrize("epochs", [1.0, 1.7])
def test_expected_tokens_meet_the_targets(spark, epochs):
    docs, labels = corpus(spark)
    targets = {"high": 0.5, "low": 0.3, "toxic": 0.2}
    found = mixing.rates(docs, mixing.domain_labels(labels), targets, epochs)
    total, got = totals(found, targets)
    assert got == pytest.approx(np.array([0.5, 0.3, 0.2]) * total * epochs, rel=1e-6)
    assert found.filter("rate < 0").count() == 0 and found.count() == docs.count()


@pytest.fixture(scope="module")
def posteriors(spark):
    docs, labels = corpus(spark, 500)
    domains = mixing.fit_domains(docs, mixing.domain_labels(labels), ["high", "low", "toxic"])
    return stage(mixing.with_posteriors(docs, domains)[0].select("n_tokens", "p_high", "p_low", F.col("p_toxic_").alias("p_toxic")).coalesce(2), "posteriors")


def check_optimum(p, t, r, target, least):
    """Optimality conditions of the bounded least squares (no rate can move to a smaller
    residual), and no worse than accelerated projected gradient over all rates."""
    assert (r >= least).all()
    residual = (p.T * t) @ r - target
    slope = p @ residual / t.sum()
    assert slope.min() > -1e-5 and np.abs(slope[r > least * (1 + 1e-9)]).max(initial=0) < 1e-5
    other = least_squares(p, t, target, least) - target
    assert (residual**2).sum() <= (other**2).sum() + 1e-12 * t.sum() ** 2
    return residual / t.sum()


def least_squares(p, t, target, least, rounds=5000):
    a = p.T * t
    scale = 1 / (t**2).sum()
    r = y = np.full(len(t), max(1.0, least))
    for i in range(rounds):
        new = np.maximum(least, y - scale * (a.T @ (a @ y - target)))
        y = new + i / (i + 3) * (new - r)
        r = new
    return a @ r


@pytest.mark.parametrize(("shares", "least"), [((0.0, 0.0, 1.0), 0.0), ((0.02, 0.95, 0.03), 0.0), ((0.02, 0.95, 0.03), 1.0), ((0.8, 0.15, 0.05), 1.0)])
def test_rates_are_the_least_squares_optimum(posteriors, shares, least):
    names = ["p_high", "p_low", "p_toxic"]
    data = posteriors.toPandas()
    p, t, share = data[names].to_numpy(), data["n_tokens"].to_numpy(float), np.array(shares)
    fit = mixing.fit_rates(posteriors, "n_tokens", names, list(shares), 0.9, least)
    target = share * t.sum() * 0.9
    if least:
        target *= max((t @ p)[i] / (share[i] * t.sum()) for i in range(3))
    residual = check_optimum(p, t, mixing.rates_of(p, fit.steps, least), target, least)
    assert fit.residual == pytest.approx(residual, abs=1e-7)


def test_many_documents_at_the_bound_still_meet_the_targets(spark):
    """Nearly pure posteriors: most rates of the unwanted domain must reach zero."""
    rng = np.random.default_rng(6)
    x = rng.dirichlet([0.3, 0.1, 0.05], 3000)
    frame = spark.createDataFrame([(i, int(n), *map(float, row)) for i, (n, row) in enumerate(zip(rng.integers(1, 400, 3000), x, strict=True))], "doc_id long, n long, a double, b double, c double").repartition(3)
    fit = mixing.fit_rates(frame, "n", ["a", "b", "c"], [0.05, 0.15, 0.8], 2.0)
    assert np.abs(fit.residual).max() < 1e-8 and len(fit.steps) < 40
    rate = mixing.rates_of(x, fit.steps, 0.0)
    assert (rate == 0).mean() > 0.2


def test_mixed_posteriors_beyond_reach(spark):
    """No document is mostly of the wanted domain: the optimum misses it by far."""
    rng = np.random.default_rng(7)
    x, t = rng.dirichlet([3, 1, 0.5], 800), rng.integers(1, 400, 800).astype(float)
    frame = spark.createDataFrame([(int(n), *map(float, row)) for n, row in zip(t, x, strict=True)], "n long, a double, b double, c double").repartition(2)
    fit = mixing.fit_rates(frame, "n", ["a", "b", "c"], [0.0, 0.0, 1.0])
    residual = check_optimum(x, t, mixing.rates_of(x, fit.steps, 0.0), np.array([0, 0, t.sum()]), 0.0)
    assert np.abs(residual).max() > 0.05 and fit.residual == pytest.approx(residual, abs=1e-7)


def test_a_fit_that_does_not_converge_raises(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    monkeypatch.setattr(mixing, "_NEWTON", 1)
    frame = spark.createDataFrame([(1, 10, 0.9, 0.1), (2, 20, 0.4, 0.6), (3, 5, 0.1, 0.9)], "doc_id long, n long, a double, b double")
    with pytest.raises(RuntimeError, match="not converged"):
        mixing.fit_rates(frame, "n", ["a", "b"], [0.01, 0.99])


def test_copies_follow_the_rates(spark):
    docs, labels = corpus(spark)
    targets = {"high": 0.5, "low": 0.3, "toxic": 0.2}
    mixed = mixing.mix(docs, mixing.domain_labels(labels), targets)
    assert mixed.columns == docs.columns
    rate = {r.doc_id: r.rate for r in mixing.rates(docs, mixing.domain_labels(labels), targets).collect()}
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(abs(copies.get(i, 0) - r) < 1 for i, r in rate.items())
    assert sum(copies.values()) == pytest.approx(sum(rate.values()), rel=0.05)


def test_mixing_of_awkward_documents(awkward, no_docs, no_labels):
    found = mixing.rates(awkward, mixing.domain_labels(no_labels))
    assert found.count() == awkward.count()
    assert all(r.rate == 1 for r in found.collect() if r.n_tokens == 0)
    assert mixing.mix(awkward, mixing.domain_labels(no_labels)).columns == awkward.columns
    assert mixing.rates(no_docs, mixing.domain_labels(no_labels)).count() == 0
