from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from bazaarcube.llm import langid, lm_score, ppm
from llm.brute import Ppm, words_of
from llm.conftest import TEXTS

TRAIN = ["the cat sat on the mat", "the dog sat", None, "", "été à la mer", "a" * 50]
TEST = ["the cat", "zebra", "", None, "été", "\x00\x01", "the dog sat on a cat"]


def model(texts, exclusion):
    counter = ppm.Counter()
    ppm.count_grams(pa.array(texts, pa.string()), counter)
    return ppm.Model(*counter.merge(), exclusion=exclusion)


@pytest.mark.parametrize("exclusion", [True, False])
def test_code_lengths_equal_those_of_explicit_tries(exclusion):
    made, plain = model(TRAIN, exclusion), Ppm(TRAIN)
    expected = [plain.bits(t, exclusion) for t in TEST]
    assert made.lengths(pa.array(TEST)) == pytest.approx(expected, rel=1e-5)


def test_probabilities_with_exclusion_sum_to_one():
    made = model(TRAIN, True)
    times = np.append(np.ones(made.a - 1), ppm.N_SYMBOLS - made.a + 1)
    assert (np.exp2(-made.cost.reshape(-1, made.a).astype(float)) @ times) == pytest.approx(1, rel=1e-5)


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    made, text = model(TRAIN, True), pa.array(["the cat sat " * 50, "x"])
    whole = made.lengths(text)
    monkeypatch.setattr(ppm.pieces, "__defaults__", (40,))
    assert made.lengths(text) == pytest.approx(whole)


def test_several_models_in_one_index():
    models = [model(TRAIN[:2], False), model(TRAIN[4:], False)]
    together = ppm.Models(models).lengths(pa.array(TEST))
    for i, one in enumerate(models):
        assert together[:, i] == pytest.approx(one.lengths(pa.array(TEST)), rel=1e-6)


def test_a_reduced_trie_still_scores_everything():
    counter = ppm.Counter()
    ppm.count_grams(pa.array(TRAIN, pa.string()), counter)
    codes, counts = counter.merge()
    short, inverse = np.unique(codes & np.uint64((1 << 27) - 1), return_inverse=True)
    made = ppm.Model(codes[:5], counts[:5], (short, np.bincount(inverse, counts)))
    assert np.isfinite(made.lengths(pa.array(TEST))).all()


def held(doc_id, by):
    return zlib.crc32(str(doc_id).encode()) % by


def test_scores_of_awkward_texts(awkward):
    got = lm_score.score(awkward, frequent=4).collect()  # most words take the join
    train = [t for i, t in TEXTS if i is not None and held(i, 7) != 2]
    counts: dict = {}
    for text in train:
        for word in [*words_of(text), None]:
            counts[word] = counts.get(word, 0) + 1
    n, v = sum(counts.values()), len(counts)
    plain = Ppm(train)
    expected = []
    for i, text in TEXTS:
        tokens = [*words_of(text), None]
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        bits = plain.bits(text) if len(text or "") < 1000 else None
        known = sum(w in counts for w in tokens)
        expected.append((i, i is None or held(i, 7) == 2, len(tokens), known, n, base, bits))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    for row, want in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert row[:5] == want[:5]
        assert row[5] == pytest.approx(want[5])
        if want[6] is not None:
            assert row[6] == pytest.approx(-want[6] * math.log10(2), rel=1e-5)


def test_scores_without_documents(no_docs, spark):
    assert lm_score.score(no_docs).count() == 0
    only_held = spark.createDataFrame([(i, "some text") for i in range(40) if held(i, 7) == 2], "doc_id long, text string")
    rows = lm_score.score(only_held).collect()
    assert rows and all(r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in rows)


def test_languages_of_awkward_texts(awkward, no_docs):
    rows = langid.identify(awkward).collect()
    assert len(rows) == len(TEXTS)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {4, 5, 6, 15, None}  # of the rows without an id one has no text
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "und") for r in rows)
    assert all(r.held_out == (r.doc_id is None or held(r.doc_id, 3) == 1) for r in rows)
    assert langid.identify(no_docs).count() == 0


def test_nothing_to_learn_a_language_from(awkward):
    from pyspark.sql import functions as F

    rows = langid.identify(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).filter("held_out").join(docs, "doc_id")
    right, n = found.selectExpr("sum(int(lang_pred = lang))", "count(*)").first()
    assert right / n > 0.9


@pytest.mark.parametrize(("contexts", "depth"), [(4, 3), (1 << 16, 5), (4, 5)])
def test_no_context_is_lost_beyond_the_broadcast(spark, contexts, depth):
    texts = [*TRAIN * 3, *TEST, "日本語のテキスト", "日本の本", "the cat sat on the mat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    plain = Ppm([t for i, t in enumerate(texts) if held(i, 7) != 2], depth)
    rows = lm_score.score(docs, contexts=contexts, frequent=4, depth=depth).collect()
    assert len(rows) == len(texts) and any(r.held_out for r in rows)
    for r in rows:
        assert r.score == pytest.approx(-plain.bits(texts[r.doc_id]) * math.log10(2), rel=1e-5)


def test_no_context_of_a_language_is_lost_beyond_the_broadcast(spark):
    texts = [("en", t) for t in TRAIN[:2] * 4] + [("fr", "été à la mer")] * 6 + [("ja", "日本語のテキスト")] * 6 + [(None, "日本の本"), (None, "the été"), (None, "zebra")]
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    plain = {
        g: Ppm([t for i, (lang, t) in enumerate(texts) if lang == g and held(i, 3) != 1]) for g in ("en", "fr", "ja")
    }
    rows = langid.identify(docs, contexts=3).collect()
    assert len(rows) == len(texts)
    for r in rows:
        bits = {g: p.bits(texts[r.doc_id][1], exclusion=False) for g, p in plain.items()}
        best = min(bits, key=bits.get)
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 / sum(2 ** (bits[best] - b) for b in bits.values()), rel=1e-4)


def test_only_letters_are_letters(spark):
    texts = ["½", "²", "① Ⅳ 5", "٣", "__", "ª", "é", "日", "a1", "ʰ", "☃ 12", "", None]
    want = [False, False, False, False, False, True, True, True, True, True, False, False, False]
    assert langid.has_letter(pa.array(texts, pa.string())).tolist() == want
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(100, "the cat", "en"), (102, "the dog", "en")], "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert [found[i] == "und" for i in range(len(texts))] == [not w for w in want]


def test_a_task_passes_its_counts_on(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"lang": ["a", "b"], "text": [f"some words {i}", f"andere {i}"]}) for i in range(20)]

    def total():
        out: dict = {}
        for b in langid._count(iter(batches)):
            for x, c, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                out[x, c] = out.get((x, c), 0) + n
        return out

    whole = total()
    monkeypatch.setattr(langid, "FLUSH", 10)
    monkeypatch.setattr(ppm.Counter, "add", lambda self, codes: (self.wait.append(np.unique(codes, return_counts=True)), self.merge()))
    assert total() == whole
