from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from bazaarcube.session import stage
from llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, apply in corpus_pipeline.STAGES:
        docs.append(stage(apply(spark, docs[-1], SF), f"test-{name}"))
    return docs


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns_of_documents(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minmax_near_dedup", "mixing", "packing"]
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_toxic_documents_go(steps, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {i for i, _ in texts(steps[1])}
    clean = {r.doc_id for r in labels.filter("toxic = 0").collect()}
    assert len(clean - kept) <= 0.05 * len(clean)


def test_lines_against_brute_force(steps):
    rows = texts(steps[1])
    want = sorted((i, kept) for (i, _), (_, _, kept) in zip(rows, brute.kept_lines(rows), strict=True))
    assert sorted(texts(steps[2])) == want


def forms(steps):
    """The documents that line dedup kept, with their texts before and after it."""
    before, after = dict(texts(steps[0])), texts(steps[2])
    return [(i, t) for i, cut in after for t in dict.fromkeys([before[i], cut])]


def test_near_duplicates_against_brute_force(steps):
    component = brute.near_duplicates(forms(steps))
    assert sorted(i for i, _ in texts(steps[3])) == sorted(i for i, _ in texts(steps[2]) if component[i] == i)


def test_only_the_first_of_a_group_reaches_mixing(steps):
    """Whole, empty or cut by line dedup, a near copy of an earlier document goes."""
    kept = {i for i, _ in texts(steps[1])}
    whole = brute.near_duplicates([(i, t) for i, t in texts(steps[0]) if i in kept])
    copies = {i for i, c in whole.items() if c != i}
    assert copies and not copies & {i for i, _ in texts(steps[3])}
    before = dict(texts(steps[0]))
    emptied = {i for i, t in texts(steps[3]) if not (t or "").strip() and (before[i] or "").strip()}
    assert not emptied & copies


def test_the_stage_alone_compares_what_it_is_given(spark, tmp_path):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, "other text of a few words more"), (None, "x"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(9, "unrelated")], docs.schema).write.parquet(f"{tmp_path}/documents.parquet")
    found = texts(corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)))
    assert sorted(str(i) for i, _ in found) == ["1", "3", "4", "5", "None"]


def test_mixing_repeats_whole_documents(steps):
    before, after = dict(texts(steps[3])), texts(steps[4])
    assert {i for i, _ in after} == set(before)
    assert all(before[i] == t for i, t in after) and len(after) > len(before)


def test_packing_holds_every_document(steps):
    assert sorted(r.doc_id for r in steps[5].collect()) == sorted(i for i, _ in texts(steps[4]))


def test_run_and_registration(spark, steps):
    assert entry.queries()["pipeline"](spark, SF).count() == steps[5].count()
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14)) and len(names) == 13


def test_mixing_keeps_every_document_of_a_large_low_source(spark, tmp_path):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(300)}" for _ in range(50)]
        low = i % 3 == 1  # a third of the tokens
        docs.append((i, " ".join(w.upper() + "!!" if low else w for w in words)))
        if i % 2:
            labels.append((i, int(not low), 0))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    after = [i for i, _ in texts(corpus_pipeline.mix(spark, df, str(tmp_path)))]
    assert set(after) == {i for i, _ in docs}
    assert sum(i % 3 == 1 for i in after) / len(after) == pytest.approx(corpus_pipeline.TARGETS["low"], abs=0.02)
