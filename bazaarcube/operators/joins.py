"""Joins to dimensions whose broadcast is decided by a measured row count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarcube.session import broadcast_rows, stage

#: Keys with packed codes that take the memory of one broadcast row: a code has 4 bytes.
PACKED_KEYS = 16
#: Different rows of labels that codes may stand for.
LABEL_SETS = 1 << 16
#: Places for keys, as a multiple of the keys there are.
SPREAD = 4
#: Keys in one packed row, as bits.
BLOCK_BITS = 8


def fits_broadcast(df: DataFrame, rows: int) -> bool:
    return rows <= broadcast_rows(df.sparkSession)


def join_dim(left: DataFrame, dim: DataFrame, on: str, how: str, rows: int) -> DataFrame:
    """Join ``dim``, whose stored table holds ``rows`` rows.

    A small dimension is broadcast. A larger one is joined by shuffle, where
    adaptive execution splits the partition of a hot key on the left side.
    """
    return left.join(F.broadcast(dim) if fits_broadcast(dim, rows) else dim, on, how)


def join_key(left: DataFrame, dim: DataFrame, on: str, how: str, rows: int) -> DataFrame:
    """Join ``dim``, an id and its surrogate key, like ``join_dim``; where it is larger than a
    broadcast but its ids are unique integers without wide gaps, the keys are packed by id."""
    (name,) = [c for c in dim.columns if c != on]
    if not fits_broadcast(dim, rows) and left.schema[on].dataType == dim.schema[on].dataType:
        packed = pack_labels(dim.withColumn("_found", F.lit(True)), on, rows, [name])
        if packed:
            return join_packed(left, packed, on, how).drop("_found")
    return join_dim(left, dim, on, how, rows)


def pack_labels(lookup: DataFrame, key: str, rows: int, ids: Sequence[str] = ()) -> tuple[DataFrame, DataFrame] | None:
    """A dimension beyond the broadcast limit whose labels have few different rows, as
    two tables that can be broadcast: arrays of codes for blocks of keys, and the labels of
    each code. Integer ``ids``, which differ by key, are arrays beside the codes. None where
    there are too many keys or labels, keys lie far apart, or a key has several rows."""
    spark = lookup.sparkSession
    labels = [c for c in lookup.columns if c not in (key, *ids)]
    known = lookup.filter(F.col(key).isNotNull())
    if rows > PACKED_KEYS // (2 if ids else 1) * broadcast_rows(spark) or len(ids) > 1:
        return None
    if any(not isinstance(lookup.schema[c].dataType, T.IntegralType) for c in (key, *ids)):
        return None
    found = known.agg(F.approx_count_distinct(F.struct(*labels)), F.approx_count_distinct(F.shiftright(key, BLOCK_BITS)))
    sets, filled = found.first()
    if sets > LABEL_SETS or filled << BLOCK_BITS > SPREAD * rows + (SPREAD << BLOCK_BITS):
        return None
    # as many rows as there are different labels, so one task may number them
    numbered = known.select(*labels).distinct().withColumn("_code", F.row_number().over(Window.orderBy(*labels)))
    codes = stage(numbered, "label-codes")
    same = [F.col(f"_of.{c}").eqNullSafe(F.col(f"_to.{c}")) for c in labels]
    coded = known.alias("_of").join(F.broadcast(codes.alias("_to")), same).select(*[F.col(f"_of.{c}").alias(c) for c in (key, *ids)], "_code")
    place = F.struct(F.col(key).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("at"), "_code", *ids)
    blocks = stage(coded.groupBy(F.shiftright(key, BLOCK_BITS).alias("_block")).agg(F.collect_list(place).alias("codes")), "packed-keys")
    if not blocks.filter(F.size(F.array_distinct("codes.at")) < F.size("codes")).isEmpty():
        return None
    every = F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1))
    of = blocks.withColumns({f"_at_{c}": F.map_from_arrays("codes.at", f"codes.{c}") for c in ("_code", *ids)})

    def spread(c: str) -> Column:
        return F.transform(every, lambda i: F.try_element_at(f"_at_{c}", i)).alias(f"_all_{c}")

    return stage(of.select("_block", *[spread(c) for c in ("_code", *ids)]), "packed-labels"), codes


def join_packed(left: DataFrame, packed: tuple[DataFrame, DataFrame], key: str, how: str = "inner") -> DataFrame:
    """``left`` with the labels of its keys, without a shuffle; keys without labels drop out,
    or (``how`` is left) have NULLs."""
    blocks, codes = packed
    found = left.join(F.broadcast(blocks), F.shiftright(key, BLOCK_BITS) == F.col("_block"), how)
    place = F.col(key).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
    values = [F.get(c, place).alias(c.removeprefix("_all_")) for c in blocks.columns if c != "_block"]
    return found.select(*left.columns, *values).join(F.broadcast(codes), "_code", how).drop("_code")
