from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from bazaarcube.llm import embed_dedup, minhash
from bazaarcube.llm.components import components
from llm import brute
from llm.conftest import TEXTS


def check_docs(df, rows):
    component = brute.near_duplicates(rows)
    got = minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for i, t in rows:
        sizes.setdefault(i, set()).add(len(brute.shingle_set(t)))
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        assert (r.component_id, r.kept) == ((component[r.doc_id], component[r.doc_id] == r.doc_id) if r.doc_id is not None else (None, True))


def test_awkward_documents(awkward):
    check_docs(awkward, TEXTS)


def test_one_of_each_group_stays_with_all_columns(awkward):
    out = minhash.keep_one(awkward)
    assert out.columns == awkward.columns
    component = brute.near_duplicates(TEXTS)
    kept = sorted(str(i) for i, _ in TEXTS if i is None or component[i] == i)
    assert sorted(str(r.doc_id) for r in out.collect()) == kept


def test_no_documents(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0


def variants(n, seed, words=120, edits=9):
    """Documents around one text, many pairs of them just above or below the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        yield " ".join(text)


def test_dense_groups_lose_no_link(spark):
    texts = [*variants(120, 1), *variants(80, 2, edits=14), *variants(60, 3, words=30, edits=3)]
    random.Random(5).shuffle(texts)
    rows = list(enumerate(texts))
    check_docs(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_what_leaders_leave_open_is_compared_too(spark):
    rows = list(enumerate(variants(90, 4, edits=16)))
    check_docs(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_similarity_at_the_threshold():
    a = " ".join(f"w{i}" for i in range(11))  # 7 shingles
    b = " ".join(f"w{i}" for i in range(10))  # 6 of them: 6/7
    c = " ".join(f"w{i}" for i in range(9))  # 5 of a's 7
    d = " ".join(f"w{i}" for i in range(8))  # 4; of c's 5: 0.8, of b's 6: 0.67
    assert list(minhash.similar(pa.array([a, a, c, b, None, ""]), pa.array([b, c, d, d, None, "x"]))) == [True, False, True, False, False, False]
    three = " ".join(f"w{i}" for i in range(7))  # 3 shingles; of d's 4: exactly 0.75
    assert list(minhash.similar(pa.array([d]), pa.array([three]))) == [True]


def test_components_of_a_path_and_a_star(spark):
    n = 300
    path = [(i, i + 1) for i in range(n)]
    star = [(1000, 1000 + i) for i in range(1, n)] + [(5000, 5000), (7, 7)]
    got = components(spark.createDataFrame(path + star, "a long, b long"), "a", "b").collect()
    assert {r.id: r.component for r in got} == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(n)}}
    assert len(got) == 2 * n + 1


def brute_vectors(rows, threshold=0.95):
    good = [
        (i, v) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]

    def linked(x, y):
        if len(x) != len(y):
            return False
        x, y = (np.array(v) / max(map(abs, v)) for v in (x, y))
        return x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold

    links = [(n, m) for n in range(len(good)) for m in range(n) if linked(good[n][1], good[m][1])]
    degree: dict = {}
    for n, m in links:
        for k in (n, m):
            degree[k] = degree.get(k, 0) + 1
    by_id: dict = {}
    for k, (i, _) in enumerate(good):
        by_id.setdefault(i, []).append(degree.get(k, 0))
    ids = sorted({i for i, _ in rows if i is not None})
    return by_id, brute.components(ids, [(good[n][0], good[m][0]) for n, m in links])


def check_vectors(spark, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, id int").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]  # as single precision
    degree, component = brute_vectors(rows)
    got = embed_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    found: dict = {}
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
            continue
        assert (r.component_id, r.kept) == (component[r.vec_id], component[r.vec_id] == r.vec_id)
        found.setdefault(r.vec_id, []).append(r.n_links)
    for i, links in found.items():
        assert sorted(links) == sorted((degree.get(i, []) + [0] * len(links))[: len(links)])


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0]), (4, [0.0, 1.0, 0.0]), (5, None), (6, []),
        (7, [0.0, 0.0, 0.0]), (8, [nan, 1.0, 0.0]), (9, [inf, 1.0, 0.0]), (10, [None, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]),
        (11, [1.0, 0.0]), (12, [1.0, 0.05]), (13, [-1.0, 0.0, 0.0]), (14, [1e30, 1e30, 0.0]), (15, [1e-30, 1e-30, 0.0]),
        (4, [0.0, 1.0, 0.0]), (20, [0.0, 1.0, 0.0]), (21, [0.0, 0.0, 1.0]),
    ]
    check_vectors(spark, rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("leaf", [embed_dedup.LEAF, 8])
def test_clusters_of_vectors(spark, monkeypatch, leaf):
    monkeypatch.setattr(embed_dedup, "LEAF", leaf)
    monkeypatch.setattr(embed_dedup, "BLOCK", 64)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    x = np.concatenate([centres[k % 12] + rng.normal(size=24) * (0.05 + 0.02 * (k % 9)) for k in range(420)]).reshape(-1, 24)
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # one common vector
    check_vectors(spark, rows)


def test_vectors_are_not_shuffled_for_each_pair(spark, monkeypatch):
    """Blocks meet in tasks that hold some of them and read the others; the held groups and
    what a task collects are small here, so that there are several of each."""
    monkeypatch.setattr(embed_dedup, "BLOCK", 32)
    monkeypatch.setattr(embed_dedup, "HELD_BYTES", 20_000, raising=False)
    monkeypatch.setattr(embed_dedup, "FOUND", 40, raising=False)
    joined, frame = [], type(spark.range(0))
    usual = frame.mapInArrow

    def seen(df, *args, **more):
        if any(c.endswith("x") for c in df.columns):
            joined.append(df._jdf.queryExecution().executedPlan().toString())
        return usual(df, *args, **more)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(10, 16))
    x = [centres[k % 10] + rng.normal(size=16) * (0.1 + 0.03 * (k % 5)) for k in range(300)]
    check_vectors(spark, [(i, [float(v) for v in x[i]]) for i in range(len(x))])
    assert joined
    assert not [plan for plan in joined if "Exchange" in plan.replace("BroadcastExchange", "")]


def test_packed_counts_add_up():
    """Chunks without counts, counts beyond 32 bits, several tasks."""
    rng = np.random.default_rng(1)
    parts = [np.where(rng.random(1 << minhash.COUNT_BITS) < 0.001, rng.integers(0, 1 << 40, 1 << minhash.COUNT_BITS), 0) for _ in range(3)]
    parts.append(np.zeros(1 << minhash.COUNT_BITS, np.int64))
    parts[0][: 4 * minhash.COUNT_CHUNK] = 0
    (total,) = minhash._totals(minhash.packed(p) for p in parts)
    got = np.zeros(1 << minhash.COUNT_BITS, np.int64)
    minhash.add_packed(got, total)
    assert (got == sum(parts)).all()


def test_many_open_documents_are_joined(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BROADCAST_IDS", 0)
    rows = list(enumerate([*variants(60, 2, edits=14), *variants(40, 3, words=30, edits=3)]))
    check_docs(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
