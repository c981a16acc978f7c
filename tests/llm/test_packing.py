from __future__ import annotations

import itertools
import random

from bazaarcube.llm import packing
from llm.brute import words_of
from llm.conftest import TEXTS


def padding(bins, bounds):
    return sum(min(b for b in bounds if b >= top) * n - tokens for top, n, tokens in bins)


def test_bounds_are_optimal():
    rng = random.Random(1)
    for _ in range(60):
        tops = sorted(rng.sample(range(60), rng.randrange(1, 9)))
        bins = [(t, n, t * n - rng.randrange(min(3, t * n + 1))) for t in tops for n in [rng.randrange(1, 9)]]
        k = rng.randrange(1, 5)
        best = min(padding(bins, [*c, tops[-1]]) for r in range(k) for c in itertools.combinations(tops[:-1], r))
        bounds = packing.best_bounds(bins, k)
        assert len(bounds) <= k and padding(bins, bounds) == best
    assert packing.best_bounds([]) == []


def check(rows, n_docs, budget, buckets):
    assert len(rows) == n_docs
    batches: dict = {}
    bounds = {r.bucket: r.padded_length for r in rows}
    assert len(bounds) <= buckets and sorted(bounds.values()) == [bounds[b] for b in sorted(bounds)]
    for r in rows:
        assert r.n_tokens <= r.padded_length
        assert all(b >= r.bucket for b, top in bounds.items() if top >= r.n_tokens)
        batches.setdefault(r.batch_id, []).append(r)
    for found in batches.values():
        assert len({r.bucket for r in found}) == 1
        assert sorted(r.position for r in found) == list(range(len(found)))
        assert len(found) * found[0].padded_length <= budget or len(found) == 1
    return batches


def test_awkward_documents(awkward, no_docs):
    rows = packing.pack(awkward, 3, 100).collect()
    check(rows, len(TEXTS), 100, 3)
    assert sorted(r.n_tokens for r in rows) == sorted(len(words_of(t)) for _, t in TEXTS)
    assert packing.pack(no_docs).count() == 0


def test_a_large_bucket_is_split_and_batches_are_full(spark):
    rows = [(i, "word " * (5 if i % 3 else 1 + i % 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = packing.pack(df, 4, 200, group=300)
    batches = check(out.collect(), 3000, 200, 4)
    groups = {b.rsplit("-", 1)[0] for b in batches}
    assert len(groups) > 4
    for g in groups:  # only the last batch of a group may have room
        sizes = {int(b.rsplit("-", 1)[1]): len(v) for b, v in batches.items() if b.rsplit("-", 1)[0] == g}
        assert len({n for i, n in sizes.items() if i < max(sizes)}) <= 1
    again = packing.pack(df.repartition(3), 4, 200, group=300)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_bounds_of_long_documents_are_optimal(spark):
    sizes = [5000 + i for i in range(40)] * 2 + [5039] * 5
    df = spark.createDataFrame([(i, "a " * n) for i, n in enumerate(sizes)], "doc_id long, text string")
    rows = packing.pack(df, 3, 10**6).collect()
    exact = [(n, sizes.count(n), n * sizes.count(n)) for n in sorted(set(sizes))]
    best = min(padding(exact, [a, b, 5039]) for a, b in itertools.combinations(range(5000, 5039), 2))
    assert sum(r.padded_length - r.n_tokens for r in rows) == best
