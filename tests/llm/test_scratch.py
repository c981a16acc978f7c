"""What the operators store on their way goes once the next step is stored."""

from __future__ import annotations

import corpus_pipeline
from bazaarcube.llm import line_dedup
from bazaarcube.session import folder_names, shared_dir
from llm.test_near_dedup import variants


def stored(spark):
    return set(folder_names(spark, shared_dir(spark)))


def kinds(names):
    return {n.rsplit("-", 1)[0] for n in names}


def test_line_dedup_leaves_only_its_bitmaps(spark):
    before = stored(spark)
    rows = [(i, f"a line that everyone repeats\nown line number {i}") for i in range(50)]
    out = line_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(r.n_dropped for r in out.collect()) == 49
    assert kinds(stored(spark) - before) == {"bitmaps"}


def test_near_dedup_leaves_no_other_forms_and_no_classes(spark, tmp_path):
    rows = list(enumerate(variants(20, 5)))
    docs = spark.createDataFrame(rows + [(None, "x y")], "doc_id long, text string")
    came = [(i, t + " end of it") for i, t in rows]
    spark.createDataFrame(came, docs.schema).write.parquet(f"{tmp_path}/documents.parquet")
    before = stored(spark)
    found = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert [r.doc_id for r in found.collect() if r.doc_id is None] == [None]
    left = kinds(stored(spark) - before)
    assert "candidate-texts" in left
    assert not left & {"forms", "classes", "signed", "buckets", "leaders"}
