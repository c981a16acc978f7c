"""Exact line dedup across documents, with DataFrame functions only.

Every line that is long enough is hashed (128 bits). The hashes are range-partitioned
and sorted within the partitions by hash, document and position, so that the first
occurrence of a line comes first in a sorted stream. A hash is dealt over as many
sub-streams as there are shuffle partitions (by a hash of the document), so a line
that a third of all documents hold is no single task's work: what follows the first
document of its sub-stream is dropped at once, and the first documents of all
sub-streams (few for a hash) are then compared with each other.

The result is not text but, for each document with dropped lines, a keep bitmap in
words of 64 lines; words that keep everything are left out.

Defined cases: a null or empty text is one empty line; rows without an id keep all
lines and count for no other document; rows of one id are one document (a line that
only they share stays), each with its own lines, told apart by a hash of the text.
Other columns, whatever their names, are carried along by ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarcube.llm.tables import ascii_lower, fresh_names, shuffle_parts
from bazaarcube.session import new_folder, remove_folder, stage, stage_at

BLANKS = " \t\n\x0b\x0c\r"
#: Shorter keys (in code points) never drop a line.
MIN_KEY = 10


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def keep_bitmaps(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """doc_id, text_hash, bitmap (word number -> bits of kept lines) and n_dropped of
    every document that loses lines. The lines are stored twice on the way; what is stored
    goes as soon as the next step is."""
    spark = docs.sparkSession
    parts, cut, sorted_lines = shuffle_parts(spark), new_folder(spark, "lines"), new_folder(spark, "line-stream")
    lines = (
        docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .filter(F.char_length("key") >= min_key)
        .select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    lines = stage_at(lines.withColumn("sub", F.pmod(F.xxhash64("doc_id"), F.lit(parts))), cut)
    stream = Window.partitionBy("h1", "h2", "sub").orderBy("doc_id", "pos")
    seen = (
        lines.repartitionByRange(parts, "h1", "h2", "sub")
        .sortWithinPartitions("h1", "h2", "sub", "doc_id", "pos")
        .withColumn("first", F.first("doc_id").over(stream))
    )
    seen = stage_at(seen, sorted_lines)
    remove_folder(spark, cut)
    followers = seen.filter(F.col("doc_id") > F.col("first"))
    heads = seen.filter(F.col("doc_id") == F.col("first"))
    # a hash with a single first document has nothing to compare
    owners = (
        heads.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .filter(F.col("owner") < F.col("last"))
    )
    later = heads.join(owners, ["h1", "h2"]).filter(F.col("doc_id") > F.col("owner"))
    place = ["doc_id", "text_hash", "pos"]
    words = (
        followers.select(*place).union(later.select(*place))
        .select("doc_id", "text_hash", F.shiftright("pos", 6).alias("word"), F.expr("shiftleft(1L, pos & 63)").alias("bit"))
        .groupBy("doc_id", "text_hash", "word").agg(F.bit_or("bit").alias("bits"))
    )
    entry = F.struct("word", F.bitwise_not("bits").alias("kept"))
    maps = words.groupBy("doc_id", "text_hash").agg(
        F.map_from_entries(F.collect_list(entry)).alias("bitmap"), F.sum(F.bit_count("bits")).cast("long").alias("n_dropped")
    )
    maps = stage(maps, "bitmaps")
    remove_folder(spark, sorted_lines)
    return maps


def with_kept_text(docs: DataFrame, min_key: int = MIN_KEY) -> tuple[DataFrame, str, str]:
    """``docs`` with the text that is kept and the number of dropped lines, and the
    names of these two columns."""
    kept, dropped = fresh_names(docs, ["kept_text", "n_dropped"])
    maps = keep_bitmaps(docs, min_key).withColumnsRenamed({"doc_id": "__doc", "text_hash": "__hash", "bitmap": "__map", "n_dropped": dropped})
    match = (docs["doc_id"] == maps["__doc"]) & (F.xxhash64(docs["text"]) == maps["__hash"])
    lines = lines_of(F.col("text"))
    joined = docs.join(maps, match, "left").withColumn("__lines", F.when(F.col("__map").isNotNull(), lines))
    dense = F.expr("transform(sequence(0, shiftright(size(__lines) - 1, 6)), w -> coalesce(try_element_at(__map, w), -1L))")
    joined = joined.withColumn("__dense", F.when(F.col("__map").isNotNull(), dense))
    filtered = F.expr("array_join(filter(__lines, (x, i) -> (shiftrightunsigned(__dense[shiftright(i, 6)], i & 63) & 1L) = 1L), '\\n')")
    text = F.when(F.col("__map").isNull(), F.coalesce("text", F.lit(""))).otherwise(filtered)
    return (
        joined.withColumn(kept, text).withColumn(dropped, F.coalesce(dropped, F.lit(0)).cast("long"))
        .drop("__doc", "__hash", "__map", "__lines", "__dense"),
        kept,
        dropped,
    )


def digest(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """doc_id, n_lines, n_dropped and the hash of the kept text of every row."""
    found, kept, dropped = with_kept_text(docs.select("doc_id", "text"), min_key)
    return found.select(
        "doc_id",
        F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.col(dropped).alias("n_dropped"),
        F.sha2(F.col(kept).cast("binary"), 256).alias("kept_sha256"),
    )


def dedup_lines(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """The documents with their kept text; ``n_chars``, where present, counts it."""
    found, kept, _ = with_kept_text(docs, min_key)
    changed = {"text": F.when(F.col("text").isNotNull(), F.col(kept))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("text").isNotNull(), F.char_length(kept)).otherwise(F.col("n_chars")).cast(kind)
    return found.withColumns(changed).select(*(F.col(f"`{c}`") for c in docs.columns))
