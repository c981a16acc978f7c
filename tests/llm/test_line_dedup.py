from __future__ import annotations

import hashlib

from bazaarcube.llm import line_dedup
from llm.brute import kept_lines
from llm.conftest import TEXTS


def test_awkward_lines(awkward):
    expected = [
        (i, n, gone, hashlib.sha256(text.encode()).hexdigest())
        for (i, _), (n, gone, text) in zip(TEXTS, kept_lines(TEXTS), strict=True)
    ]
    key = lambda r: tuple(map(str, r))
    got = line_dedup.digest(awkward).collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert any(r.n_dropped for r in got)


def test_documents_keep_their_columns_and_null_texts(awkward):
    out = line_dedup.dedup_lines(awkward)
    assert out.schema == awkward.schema
    texts = {r.doc_id: r.text for r in out.collect() if r.doc_id}
    assert texts[4] is None and texts[5] == "" and texts[10] == "short\nshort\n"


def test_a_line_of_many_documents_stays_in_the_first(spark):
    rows = [(i, f"a line that everyone repeats\nown line number {i}") for i in range(2000)]
    out = line_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id == 0, r.n_dropped) for r in out.collect()} == {(True, 0), (False, 1)}


def test_bitmaps_of_many_lines(spark):
    text = "\n".join(["some line of the first"] * 200 + ["short"])
    rows = [(1, "some line of the first"), (2, text)]
    out = {r.doc_id: r for r in line_dedup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(out) == {2} and out[2].n_dropped == 200
    assert sorted(out[2].bitmap) == [0, 1, 2, 3] and out[2].bitmap[0] == 0 and out[2].bitmap[3] == -1 << 8


def test_no_documents(no_docs):
    assert line_dedup.digest(no_docs).count() == 0
