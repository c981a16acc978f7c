from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from bazaarcube.llm import merkle, queries

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(nodes):
    """The top of a tree, and for each node its siblings (left, right) level by level."""
    ways = [[] for _ in nodes]
    below = [(n, [i]) for i, n in enumerate(nodes)]
    while len(below) > 1:
        above = []
        for lo in range(0, len(below), 3):
            run = below[lo : lo + 3]
            for at, (_, under) in enumerate(run):
                for i in under:
                    ways[i].append(("".join(h for h, _ in run[:at]), "".join(h for h, _ in run[at + 1 :])))
            above.append((sha("".join(h for h, _ in run)), [i for _, under in run for i in under]))
        below = above
    return (below[0][0] if below else None), ways


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((own, *climb([leaf(*r) for r in own])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (own, subroot, ways), top in zip(trees, tops, strict=True):
        for r, way in zip(own, ways, strict=True):
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            folded = leaf(*r[:4], r[4].replace("\n", "")) if cut else leaf(*r)
            for left, right in way + top:
                folded = sha(left + folded + right)
            proof = sha("".join(x + y for x, y in way + top))
            out.append((r[0], leaf(*r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def run(spark, rows, tmp_path):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, lo int, grp string")
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_merkle_manifest(spark, str(tmp_path))
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=repr)


def test_awkward_documents(spark, awkward, tmp_path):
    rows = [(r.doc_id, s, r.lang, None if n % 5 == 0 else n, r.text) for n, r in enumerate(awkward.collect()) for s in ("a", None, "é", "", "B")[: n % 6]]
    rows += [(1, "lone", "en", 3, "one\ntwo"), (2, "two", None, -3, "x"), (2, "two", None, -3, "x")]
    assert run(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("n", [1, 3, 4, 10])
def test_one_source(spark, tmp_path, n):
    rows = [(i, "s", "en", i, f"text\n{i}") for i in range(n)]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_a_hot_source_and_many_small_ones(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, "hot" if i % 3 == 0 else f"s{rng.randrange(40)}", None, i, "same text\nof many") for i in range(900)]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_only_changed_rows_fail(spark, awkward):
    docs = awkward.select("doc_id", "lang", "text", F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    assert merkle.verify(docs).filter("not verified").count() == 0
    changed = merkle.verify(docs, received={"lang": F.when(F.col("doc_id") == 3, "xx").otherwise(F.col("lang"))})
    assert [r.doc_id for r in changed.filter("not verified").collect()] == [3]


def test_no_documents(spark, tmp_path):
    assert run(spark, [], tmp_path) == []


def test_plan_does_not_grow_with_levels(spark):
    """The paths of each level are stored, so the last plan joins one level only."""
    plans = []
    for rows in (4, 90):
        docs = spark.createDataFrame([(i, "s", "en", 1, str(i)) for i in range(rows)], "doc_id long, source string, lang string, n_chars int, text string")
        found = merkle.proofs(docs)
        assert found.count() == rows
        plans.append(found._jdf.queryExecution().optimizedPlan().toString().count("Join "))
    assert plans[1] == plans[0]


def test_stored_files_follow_rows_not_shuffle_partitions(spark, tmp_path, monkeypatch):
    """Each file of a few rows costs its executor the processes that set its rights."""
    files, store = {}, merkle.stage

    def counted(df, name):
        kept = store(df, name)
        files.setdefault(name, []).append(len(kept.inputFiles()))
        return kept

    monkeypatch.setattr(merkle, "stage", counted)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    rows = [(i, "hot" if i % 4 else f"s{i % 7}", "en", i, f"text\n{i}") for i in range(120)]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for file_rows, most in ((20_000, 1), (30, 5)):  # 120 rows, 7 groups
            monkeypatch.setattr(merkle, "FILE_ROWS", file_rows, raising=False)
            files.clear()
            assert run(spark, rows, tmp_path / str(file_rows)) == brute(rows)
            assert max(n for counts in files.values() for n in counts) <= most, files
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
