"""Dense surrogate keys without sending a table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarcube.session import stage

# monotonically_increasing_id() holds the partition number above bit 33 and the
# row's position in its partition below it (documented Spark behaviour).
_POSITION_BITS = 33


def dense_keys(df: DataFrame, natural: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Add ``name``: start, start+1, ... in the order of ``natural``.

    Rows are range-partitioned and sorted by the natural key, numbered within
    their partition, and staged, so that a lost executor cannot renumber them.
    What is left is one offset per partition: a running total over as many rows
    as there are partitions. Equals ``row_number() OVER (ORDER BY natural)``.
    """
    order = [*natural, *[c for c in df.columns if c not in natural]]
    ranged = (
        df.repartitionByRange(*natural)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .select(
            "*",
            F.shiftright("_slot", _POSITION_BITS).alias("_part"),
            F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
        )
        .drop("_slot")
    )
    staged = stage(ranged, f"keys-{name}")
    offsets = (
        staged.groupBy("_part")
        .agg((F.max("_position") + 1).alias("_rows"))
        .select(
            "_part",
            F.coalesce(
                F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
        )
    )
    # One row per partition of the range shuffle, so the broadcast is bounded.
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + F.col("_position") + start).cast("int"))
        .drop("_part", "_position", "_offset")
    )


def stable_keys(df: DataFrame, natural: str, name: str, known: DataFrame | None) -> DataFrame:
    """Key ``df`` with the keys that ``known`` (an earlier state of the dimension) gave.

    Known members keep their key and get their columns from ``df``; new ones are
    numbered from the largest key on, in the order of ``natural``, wherever they fall
    among the known; known members that ``df`` lacks stay as they were, since facts may
    point to them. Without ``known`` all members are numbered from 1.
    """
    if known is None:
        return dense_keys(df, [natural], name)
    registry = known.select(natural, name)
    last = known.agg(F.max(name)).first()[0] or 0
    kept = df.join(registry, natural)
    added = dense_keys(df.join(registry, natural, "left_anti"), [natural], name, last + 1)
    gone = known.join(df.select(natural), natural, "left_anti")
    return kept.unionByName(added).unionByName(gone, allowMissingColumns=True)
