"""Language identification by prediction by partial matching.

For each language a byte-context trie of depth three is counted over all documents
that may be learned from. With the statistics frozen, each trie gives an exact code
length for every byte, escapes to shorter contexts included; the language whose trie
codes the whole text in the fewest bits is predicted, and ``score`` is its share when
the code lengths are read as probabilities.

Only bounded tables reach the driver and the tasks: of each language the successors
of its most frequent contexts of three bytes (``CONTEXTS``), all contexts of two, and
which contexts are left out. Positions in a context that a language has left out are
joined to its counts there, so every counted context takes part in the decision.

Defined cases: a null or letterless text is ``und`` with score 0; without anything to
learn from every document is. A row without an id is not learned from and counts as
held out. Rows of one id are separate rows. Equal code lengths: the first language by
name. Columns besides doc_id, text and lang are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.llm import ppm
from bazaarcube.llm.gram_counts import context_of, model, ranked, reduced, successors, suffix
from bazaarcube.llm.tables import Shared, remainder
from bazaarcube.llm.textops import buffers, slices
from bazaarcube.session import stage

#: Contexts of three bytes broadcast for each language.
CONTEXTS = 8192

_LETTER = re.compile(r"[^\W\d_]")  # letters, and other signs with a numeric value
#: Distinct codes of a language after which a task passes its counts on.
FLUSH = 1 << 21
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters: dict[str, ppm.Counter] = {}

    def out(lang: str) -> Iterator[pa.RecordBatch]:
        codes, counts = counters.pop(lang).merge()
        for lo in range(0, len(codes), 100_000):
            part = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes[part])), pa.array(codes[part].astype(np.int64)), pa.array(counts[part])],
                names=["lang", "code", "n"],
            )

    for batch in batches:
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        for lang in sorted(set(langs)):
            rows = pa.array(langs == lang)
            ppm.count_grams(batch.column("text").filter(rows), counters.setdefault(lang, ppm.Counter()))
        while sum(len(c.codes) for c in counters.values()) > FLUSH:
            yield from out(max(counters, key=lambda x: len(counters[x].codes)))
    for lang in list(counters):
        yield from out(lang)


@dataclass
class Trained:
    """``tables``: what is broadcast (of ``reduced``); ``others``: lang and context of
    the contexts that are not, with their successors (``here``, total ``t`` and number
    ``d``), None if all are."""

    tables: tuple[pa.Table, pa.Table, np.ndarray]
    others: DataFrame | None


def train(docs: DataFrame, contexts: int = CONTEXTS) -> Trained:
    """Counts of ``docs`` (text, lang), with a part of bounded size to broadcast."""
    known = docs.select("lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = known.mapInArrow(_count, "lang string, code long, n long")
    counts = stage(counted.groupBy("lang", "code").agg(F.sum("n").alias("n")), "lang-grams")
    found = ranked(counts, ["lang"], contexts)
    tables = reduced(counts, ["lang"], found)
    if not len(tables[2]):
        return Trained(tables, None)
    rare = found.filter("not frequent").select("lang", "context")
    here = successors(counts, ["lang"]).join(rare, ["lang", "context"], "left_semi")
    others = here.selectExpr("lang", "context", "here", "aggregate(map_values(here), 0L, (a, v) -> a + v) AS t", "size(here) AS d")
    return Trained(tables, others)


def compile_models(tables: tuple[pa.Table, pa.Table, np.ndarray]) -> tuple[list[str], ppm.Models | None]:
    long, short, rare = tables
    names = languages(short)
    made = []
    for name in names:
        own = [t.filter(pc.equal(t.column("lang"), name)) for t in (long, short)]
        made.append(model(*own, exclusion=False))
    return names, ppm.Models(made, rare) if made else None


def languages(short: pa.Table) -> list[str]:
    return sorted(set(short.column("lang").to_pylist()))


def has_letter(text: pa.Array) -> np.ndarray:
    """Whether each text has a character of a Unicode letter category (L)."""
    data, offsets = buffers(text)
    at = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    found = at[offsets[1:]] > at[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(m.group().isalpha() for m in _LETTER.finditer(text[int(i)].as_py()))
    return found


def decide(bits: np.ndarray, letter: np.ndarray, names: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Language and score by the bits of each text (row) in each language (column)."""
    if not names:
        return pa.array(["und"] * len(letter)), np.zeros(len(letter))
    best = bits.argmin(1)
    score = 1 / np.exp2(np.minimum(bits.min(1, keepdims=True) - bits, 0)).sum(1)
    langs = np.where(letter, np.array(names, object)[best], "und")
    return pa.array(langs, pa.string()), np.where(letter, score, 0.0)


def predict_texts(text: pa.Array, names: list[str], models: ppm.Models | None) -> tuple[pa.Array, np.ndarray]:
    bits = np.zeros((len(text), 0)) if models is None else models.lengths(text)
    return decide(bits, has_letter(text), names)


def predict(docs: DataFrame, trained: Trained) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with the language of each whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    shared = Shared(docs.sparkSession, trained.tables, compile_models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, models = shared.get()
        for batch in batches:
            langs, score = predict_texts(batch.column("text"), names, models)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), langs, pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    if trained.others is None:
        return docs.mapInArrow(run, out)
    names = languages(trained.tables[1])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, models = shared.get()
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            text, n = batch.column("text"), batch.num_rows
            bits, requests = models.coded(text)
            offsets, codes, times, costs = requests.runs(n)
            grams = pa.StructArray.from_arrays([pa.array(codes), pa.array(times), _lists(costs, len(names))], names=["code", "times", "costs"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)), batch.column("doc_id"), batch.column("held_out"), pa.array(has_letter(text)),
                    _lists(bits, len(names)), pa.ListArray.from_arrays(pa.array(offsets), grams),
                ],
                names=["row", "doc_id", "held_out", "letter", "bits", "grams"],
            )
            row += n

    scored = stage(
        docs.mapInArrow(
            code,
            f"row long, doc_id {kind}, held_out boolean, letter boolean, bits array<double>,"
            " grams array<struct<code: long, times: long, costs: array<double>>>",
        ),
        "lang-coded",
    )
    number = F.create_map(*(F.lit(x) for pair in ((name, i) for i, name in enumerate(names)) for x in pair))
    others = trained.others.withColumn("k", F.element_at(number, F.col("lang")))
    asked = scored.select("row", F.explode("grams").alias("g")).select("row", "g.*").withColumn("context", context_of(F.col("code")))
    # a symbol seen in the context costs its share of it; any other, the escape besides
    seen = F.element_at("here", suffix(F.col("code"), 1).cast("int"))
    exact = F.when(seen.isNotNull(), -F.log2(seen / (F.col("t") + F.col("d"))) - F.expr("costs[k]")).otherwise(-F.log2(F.col("d") / (F.col("t") + F.col("d"))))
    added = F.col("times") * exact
    more = asked.join(others, "context").groupBy("row").agg(
        F.array(*(F.sum(F.when(F.col("k") == i, added).otherwise(0.0)) for i in range(len(names)))).alias("more")
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array(batch.column("bits").flatten()).reshape(batch.num_rows, len(names))
            langs, score = decide(bits, np.array(batch.column("letter"), bool), names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), langs, pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    whole = scored.drop("grams").join(more, "row", "left")
    whole = whole.withColumn("bits", F.expr("CASE WHEN more IS NULL THEN bits ELSE zip_with(bits, more, (x, y) -> x + y) END"))
    return whole.select("doc_id", "held_out", "letter", "bits").mapInArrow(choose, out)


def _lists(values: np.ndarray, width: int) -> pa.Array:
    """A list of ``width`` numbers for each row."""
    offsets = np.arange(0, values.size + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.float64).ravel()))


def identify(docs: DataFrame, contexts: int = CONTEXTS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(True))
    rows = docs.select("doc_id", held.alias("held_out"), "text", "lang")
    trained = train(rows.filter(~F.col("held_out")), contexts)
    return predict(rows.drop("lang"), trained)
