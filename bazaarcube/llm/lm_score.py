"""Language-model scores: a byte model by partial matching, and a word-count base.

One pass over the documents that may be learned from counts byte contexts and words;
both counts are summed by Spark over the whole corpus. A second pass scores every
document with the frozen byte model (escapes and symbol exclusion, see ``ppm``) and
with the counts of the most frequent words. What is broadcast is bounded (``CONTEXTS``
contexts of three bytes, ``FREQUENT`` words), the model is not: the other contexts and
words of a document meet their counts in joins, so both may grow with the corpus. With
``depth`` above three every position is joined to the counts of its longer contexts.

Words are compared by 64-bit hashes. Defined cases: a null text is empty (one end
token); a row without an id is not learned from and counts as held out; rows of one id
are scored each by itself; with nothing to learn from every base score is 0 and the
byte model is uniform. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.llm import ppm
from bazaarcube.llm.gram_counts import columns, corrected, deeper, model, ranked, reduced, shortened
from bazaarcube.llm.tables import Shared, remainder
from bazaarcube.llm.textops import doc_of, slices, words
from bazaarcube.session import stage

#: Contexts of three bytes whose counts are broadcast.
CONTEXTS = 1 << 16
#: Bytes of the longest context.
DEPTH = ppm.ORDER
#: Words whose counts are broadcast.
FREQUENT = 1 << 18
#: The key of the end token among word hashes.
END_WORD = 0
GRAM, WORD = 0, 1


def _count(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    grams, found, docs = ppm.Counter(), ppm.Counter(), 0

    def out(kind: int, codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(codes), 100_000):
            part = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(codes[part]), kind, np.int32)), pa.array(codes[part].view(np.int64)), pa.array(counts[part])],
                names=["kind", "key", "n"],
            )

    for batch in slices(batches):
        text = batch.column("text")
        ppm.count_grams(text, grams, depth)
        found.add(words(text)[0])
        docs += len(text)
        if len(found.codes) > 1 << 21:
            yield from out(WORD, *found.merge())
            found = ppm.Counter()
        if len(grams.codes) > 1 << 21:
            yield from out(GRAM, *grams.merge())
            grams = ppm.Counter()
    yield from out(GRAM, *grams.merge())
    yield from out(WORD, *found.merge())
    yield from out(WORD, np.array([END_WORD], np.uint64), np.array([docs], np.int64))


def train(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Stored counts (kind, key, n) of the byte codes and the words of ``docs``."""
    counted = docs.select("text").mapInArrow(lambda batches: _count(batches, depth), "kind int, key long, n long")
    summed = counted.groupBy("kind", "key").agg(F.sum("n").alias("n")).filter("n > 0")
    return stage(summed, "lm-counts")


def least_count(vocabulary: DataFrame, frequent: int) -> int:
    """The least count that at most ``frequent`` words reach, by a histogram of counts:
    exact below 1024, then in 16 steps for each doubling."""
    n = F.col("n")
    step = F.when(n < 1024, n).otherwise(F.floor(F.log2(n) * 16).cast("long") + 864)
    bins = vocabulary.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    total, least = 0, 1 << 62
    for row in sorted(bins, key=lambda r: -r.least):
        total += row.words
        if total > frequent:
            break
        least = row.least
    return least


def _prepare(value: tuple) -> tuple[ppm.Model, np.ndarray, np.ndarray]:
    (long, short, rare), keys, counts = value
    return model(long, short, exclusion=True, rare=rare), keys, counts


def _scorer(shared: Shared, depth: int):
    schema = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "bits", "rest", "grams"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_model, keys, counts = shared.get()
        logs = np.log10(counts + 1.0)
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            text, n_docs = batch.column("text"), batch.num_rows
            h, first = words(text)
            doc = doc_of(first)
            signed = h.view(np.int64)
            at = np.minimum(np.searchsorted(keys, signed), len(keys) - 1)
            hit = keys[at] == signed
            base = np.bincount(doc[hit], logs[at[hit]], n_docs)
            known = np.bincount(doc[hit], minlength=n_docs)
            end = np.searchsorted(keys, END_WORD)
            if end < len(keys) and keys[end] == END_WORD:
                base, known = base + logs[end], known + int(counts[end] > 0)
            # the other words, as runs of equal words of a document
            d, w = doc[~hit], signed[~hit]
            order = np.lexsort((w, d))
            d, w = d[order], w[order]
            new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] != w[:-1])]))[: len(d)]
            times = np.diff(np.append(new, len(d)))
            offsets = np.searchsorted(d[new], np.arange(n_docs + 1))
            pairs = pa.StructArray.from_arrays([pa.array(w[new]), pa.array(times)], names=["key", "times"])
            bits, requests = byte_model.coded(text, depth)
            gram_offsets, *runs = requests.runs(n_docs)
            grams = pa.StructArray.from_arrays([pa.array(x) for x in (*runs[:2], runs[2].astype(np.float64))], names=["code", "times", "cost"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n_docs)), batch.column("doc_id"), batch.column("held_out"),
                    pa.array(np.diff(first) + 1), pa.array(known), pa.array(base),
                    pa.array(bits),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs),
                    pa.ListArray.from_arrays(pa.array(gram_offsets), grams),
                ],
                names=schema,
            )
            row += n_docs

    return run


def more_bits(scored: DataFrame, grams: DataFrame, found: DataFrame, any_rare: bool, depth: int) -> DataFrame:
    """For each row with requests, the bits that exact contexts add to (or take from)
    those of the broadcast part."""
    asked = scored.select("row", F.explode("grams").alias("g")).select("row", "g.code", "g.times", F.col("g.cost").alias("before"), "g.cost")
    if any_rare:
        rare = found.filter("not frequent").select(F.col("context").alias("at"))
        third = deeper(shortened(grams, [], 4), 3).join(rare, "at", "left_semi")
        asked = corrected(asked, third, 3)
    for order in range(4, depth + 1):
        asked = corrected(asked, deeper(shortened(grams, [], order + 1), order), order)
    return asked.groupBy("row").agg(F.sum((F.col("cost") - F.col("before")) * F.col("times")).alias("more_bits"))


def score(docs: DataFrame, contexts: int = CONTEXTS, frequent: int = FREQUENT, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    ``depth``: bytes of the longest context, 3 to 6 (a code has 63 bits)."""
    if not ppm.ORDER <= depth <= 6:
        raise ValueError("depth must be 3 to 6")
    spark = docs.sparkSession
    held = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(True))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    counts = train(rows.filter(~F.col("held_out")), depth)
    vocabulary = counts.filter(F.col("kind") == WORD).select("key", "n")
    n_all, n_distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    grams = counts.filter(F.col("kind") == GRAM).select(F.col("key").alias("code"), "n")
    third = grams if depth == ppm.ORDER else stage(shortened(grams, [], 4), "lm-third")
    found = ranked(third, [], contexts)
    tables = reduced(third, [], found)
    # The end token is always broadcast.
    enough = least_count(vocabulary, frequent)
    top = vocabulary.filter((F.col("n") >= enough) | (F.col("key") == END_WORD)).toArrow()
    keys, n = columns(top, "key", "n")
    order = np.argsort(keys)
    if not len(keys):
        keys, n, order = np.array([END_WORD]), np.array([0]), np.array([0])
    shared = Shared(spark, (tables, keys[order], n[order]), _prepare)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stage(
        rows.mapInArrow(
            _scorer(shared, depth),
            f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, bits double,"
            " rest array<struct<key: long, times: long>>, grams array<struct<code: long, times: long, cost: double>>",
        ),
        "lm-scored",
    )
    others = (
        scored.select("row", F.explode("rest").alias("w")).select("row", "w.key", "w.times")
        .join(vocabulary, "key")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_base"),
            F.sum("times").alias("more_known"),
        )
    )
    each = float(np.log10(n_all + n_distinct + 1.0))
    whole = scored.drop("rest", "grams").join(others, "row", "left")
    any_rare = len(tables[2]) > 0
    if any_rare or depth > ppm.ORDER:
        more = more_bits(scored, grams, found, any_rare, depth)
        whole = whole.join(more, "row", "left").withColumn("bits", F.col("bits") + F.coalesce("more_bits", F.lit(0.0)))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (F.col("bits") * F.lit(-float(np.log10(2.0)))).alias("score"),
    )
