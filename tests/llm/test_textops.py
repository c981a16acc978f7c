from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarcube.llm import textops
from llm.brute import fold, shingle_set, words_of

TEXT = st.one_of(st.none(), st.text(alphabet="abAB \t\n\x0b\x0c\r.é😀", max_size=60))


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=8), st.sampled_from([3, 7, 1 << 21]))
def test_words_and_shingles_agree_with_plain_python(texts, size):
    arr = pa.array(texts, pa.string())
    hashes, first = textops.words(arr, textops.BLANK, size)
    expected = [words_of(t) for t in texts]
    assert list(np.diff(first)) == [len(w) for w in expected]
    by_word = {}
    for word, h in zip([w for ws in expected for w in ws], hashes, strict=True):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)
    x, at = textops.shingles(arr, size=size)
    assert list(np.diff(at)) == [len(shingle_set(t)) for t in texts]


def test_a_slice_of_a_column_is_read_from_its_own_offset():
    arr = pa.array(["aa bb", None, "cc", "dd ee ff"])
    whole, first = textops.words(arr)
    part, _ = textops.words(arr.slice(2))
    assert list(part) == list(whole[first[2] :])


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"id": list(range(9)), "text": ["x" * 50, None, ""] * 3})
    parts = list(textops.slices([batch], size=60))
    assert len(parts) > 2 and pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


@pytest.mark.parametrize("text", ["", "A b", "ÀB", "x" * 100])
def test_only_ascii_letters_are_lowered(text):
    assert fold(text) == re.sub("[A-Z]", lambda m: m[0].lower(), text)
