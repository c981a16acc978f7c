"""Counts of byte contexts over a corpus: the part of them that is broadcast, and the
tables to which the other contexts are joined. Shared by language identification and
language-model scoring.

The tasks code every position with the broadcast part, in which a context that is not
kept is coded as its last two symbols. Positions whose own context was counted but is
not in that part are *requests*: they meet the successors of their context in a join,
which gives the cost that the whole table would have given. The size of the broadcast
is thus a matter of memory, not of the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarcube.llm import ppm

CODE_BITS = 9


def suffix(code: Column, symbols: int) -> Column:
    """The last ``symbols`` symbols of a code."""
    return code.bitwiseAND(F.lit((1 << symbols * CODE_BITS) - 1))


def context_of(code: Column) -> Column:
    """A code without its last symbol."""
    return F.shiftrightunsigned(code, CODE_BITS)


def shortened(counts: DataFrame, by: list[str], symbols: int) -> DataFrame:
    """Counts of codes of fewer symbols."""
    return counts.groupBy(*by, suffix(F.col("code"), symbols).alias("code")).agg(F.sum("n").alias("n"))


def ranked(counts: DataFrame, by: list[str], contexts: int) -> DataFrame:
    """The contexts of ``counts`` (``by`` columns, ``code`` of four symbols, ``n``), and
    whether they are among the ``contexts`` most frequent of their value of ``by``."""
    order = Window.partitionBy(*by).orderBy(F.desc("m"), "context")
    return (
        counts.groupBy(*by, context_of(F.col("code")).alias("context")).agg(F.sum("n").alias("m"))
        .select(*by, "context", (F.row_number().over(order) <= contexts).alias("frequent"))
    )


def reduced(counts: DataFrame, by: list[str], found: DataFrame) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """What is broadcast of ``counts``: the codes of the frequent contexts in ``found``
    (of ``ranked``), all codes of three symbols, and the contexts that are not frequent.
    The first is bounded by the contexts kept, the others by the alphabet."""
    kept = found.filter("frequent").select(*by, "context")
    long = counts.withColumn("context", context_of(F.col("code"))).join(kept, [*by, "context"], "left_semi").select(*by, "code", "n")
    rare = found.filter("not frequent").select("context").distinct().toArrow()
    return long.toArrow(), shortened(counts, by, 3).toArrow(), columns(rare, "context")[0]


def successors(counts: DataFrame, by: list[str], name: str = "here") -> DataFrame:
    """For each context, a map of its successors' counts: at most 257 entries."""
    symbol = suffix(F.col("code"), 1).cast("int").alias("symbol")
    return counts.groupBy(*by, context_of(F.col("code")).alias("context")).agg(
        F.map_from_entries(F.collect_list(F.struct(symbol, "n"))).alias(name)
    )


_SUM = "aggregate(map_values({}), 0L, (a, v) -> a + v)"


def deeper(counts: DataFrame, order: int) -> DataFrame:
    """Of ``counts`` of codes of ``order`` + 1 symbols: each context with its successors
    (``here``) and those of the context shortened by one symbol (``down``), with totals
    and numbers of distinct successors; ``left_`` is what ``down`` holds beside ``here``."""
    below = successors(shortened(counts, [], order), [], "down").withColumnRenamed("context", "short")
    both = successors(counts, []).withColumn("short", suffix(F.col("context"), order - 1)).join(below, "short")
    return both.select(
        F.col("context").alias("at"), "here", "down",
        F.expr(_SUM.format("here")).alias("t"), F.size("here").alias("d"),
        F.expr(_SUM.format("down")).alias("down_t"), F.size("down").alias("down_d"),
        F.expr("aggregate(map_keys(here), 0L, (a, k) -> a + down[k])").alias("taken"),
    ).selectExpr("*", "down_t - taken AS left_t", "down_d - d AS left_d")


def corrected(requests: DataFrame, table: DataFrame, order: int) -> DataFrame:
    """``requests`` (``code``, and its ``cost`` in the context of ``order`` - 1 symbols)
    with the cost in the context of ``order`` symbols, where ``table`` (of ``deeper``)
    has that context: the rule of ``ppm`` with exclusion."""
    symbol = "CAST(code & 511 AS int)"
    exact = f"""CASE WHEN at IS NULL THEN cost
      WHEN here[{symbol}] IS NOT NULL THEN -log2(here[{symbol}] / (t + d))
      WHEN down[{symbol}] IS NOT NULL THEN -log2(d / (t + d)) - log2(down[{symbol}] / (left_t + left_d))
      ELSE -log2(d / (t + d)) + CASE WHEN left_d > 0 THEN -log2(left_d / (left_t + left_d)) ELSE 0D END
        + cost + log2(down_d / (down_t + down_d)) END"""
    context = suffix(context_of(F.col("code")), order)
    return requests.join(table, context == F.col("at"), "left").select(*[c for c in requests.columns if c != "cost"], F.expr(exact).alias("cost"))


def columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(name).to_numpy(zero_copy_only=False) for name in names]


def model(long: pa.Table, short: pa.Table, exclusion: bool, rare: np.ndarray | tuple = ()) -> ppm.Model:
    codes, counts = columns(long, "code", "n")
    order = np.argsort(codes)
    short_codes, short_counts = columns(short, "code", "n")
    by_code = np.argsort(short_codes)
    return ppm.Model(
        codes[order], counts[order], (short_codes[by_code], short_counts[by_code]), exclusion, rare
    )
