"""A cleaning pipeline for training documents, built from the operators of ``llm``.

Each stage takes the documents its predecessor kept and returns documents with the
same columns; the last returns the packing of what is left. Between stages the
documents are written to the shared folder and read again.

1. toxicity: documents that the classifier chain rejects go.
2. line_dedup: lines that an earlier document already has go; their documents stay, also
   those that are empty then.
3. minmax_near_dedup: of near-duplicates the document with the smallest id stays. Line
   dedup leaves of a near copy only what differs, which no longer resembles anything,
   so documents are compared both by the text they came with and by what is left of it.
4. mixing: documents are repeated by their fitted rates, none of which is below 1, so
   every document stays. The budget follows from the fitted shares: where a domain is
   above its target, the others are repeated more.
5. packing: padded batches of documents of similar length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.llm import line_dedup, minhash, mixing, packing
from bazaarcube.llm import toxicity as toxic
from bazaarcube.llm.tables import table
from bazaarcube.session import new_folder, stage, stage_at

#: Shares of the tokens by quality, and tokens wanted for each token of the smallest mix
#: that holds every document at these shares.
TARGETS = {"high": 0.85, "low": 0.15}
EPOCHS = 1.3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = toxic.label_columns(table(spark, sf_dir, "labels"))
    return toxic.keep_clean(docs, toxic.fit(docs, labels, toxic.CATEGORIES))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` are compared in two forms: as they are, and as they came. Which documents
    have another form is seen by hashes; only texts that differ are moved and stored."""
    came = table(spark, sf_dir, "documents").select("doc_id", "text")
    mark = F.struct(F.xxhash64("text"), F.length("text"))
    now, then = docs.select("doc_id", mark.alias("now")), came.filter("text IS NOT NULL").select("doc_id", mark.alias("then"))
    changed = stage(now.join(then, "doc_id").filter(~F.col("now").eqNullSafe(F.col("then"))).select("doc_id").distinct(), "changed")
    if changed.count() <= minhash.BROADCAST_IDS:
        changed = F.broadcast(changed)
    # stored, as near-dedup reads the texts several times, until it has the texts it needs
    forms = new_folder(spark, "forms")
    other = stage_at(came.filter("text IS NOT NULL").join(changed, "doc_id", "left_semi"), forms)
    return minhash.keep_one(docs, docs.select("doc_id", "text").unionByName(other), forms)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = mixing.domain_labels(table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labels, TARGETS, epochs=EPOCHS, least=1.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("minmax_near_dedup", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: The classifiers cannot be written in SQL; the stages are tested one by one instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
