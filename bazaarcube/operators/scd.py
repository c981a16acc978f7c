"""Versioned (type 2) dimension maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarcube.operators.keys import dense_keys

VALID_FROM, VALID_TO, CURRENT = "hieuLucTu", "hieuLucDen", "laHienTai"


def first_version(snapshot: DataFrame, natural: str, key: str, day: str) -> DataFrame:
    """Every row of the first snapshot becomes the current version."""
    keyed = dense_keys(snapshot, [natural], key)
    return keyed.select(
        key,
        *snapshot.columns,
        F.lit(day).cast("date").alias(VALID_FROM),
        F.lit(None).cast("date").alias(VALID_TO),
        F.lit(True).alias(CURRENT),
    )


def merge_versions(dim: DataFrame, snapshot: DataFrame, natural: str, key: str, day: str) -> DataFrame:
    """Apply a complete snapshot valid from ``day``.

    Changed rows are closed at ``day`` and reopened as a new version, new rows
    are opened, and rows missing from the snapshot stay current. Closed versions
    pass through. Both sides of the join are unique in ``natural``, so no key
    can be hot. The result is a new table; write it beside the old one and swap.
    """
    tracked = [c for c in snapshot.columns if c != natural]
    current = dim.filter(F.col(CURRENT))
    closed = dim.filter(~F.col(CURRENT))
    new = snapshot.select(
        F.col(natural), F.lit(True).alias("_seen"), *[F.col(c).alias(f"_new_{c}") for c in tracked]
    )
    paired = current.join(new, natural, "full_outer")
    same = _all_equal(tracked)
    changed = F.col(CURRENT).isNotNull() & F.col("_seen").isNotNull() & ~same
    inserted = F.col(CURRENT).isNull()

    kept = paired.filter(~inserted).select(
        key,
        natural,
        *tracked,
        VALID_FROM,
        F.when(changed, F.lit(day).cast("date")).otherwise(F.col(VALID_TO)).alias(VALID_TO),
        (~changed).alias(CURRENT),
    )
    opened = paired.filter(inserted | changed).select(
        natural, *[F.col(f"_new_{c}").alias(c) for c in tracked]
    )
    highest = dim.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"]
    versions = dense_keys(opened, [natural], key, start=highest + 1).select(
        key,
        natural,
        *tracked,
        F.lit(day).cast("date").alias(VALID_FROM),
        F.lit(None).cast("date").alias(VALID_TO),
        F.lit(True).alias(CURRENT),
    )
    return closed.select(*versions.columns).unionByName(kept).unionByName(versions)


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(CURRENT))


def _all_equal(columns: Sequence[str]) -> Column:
    result = F.lit(True)
    for name in columns:
        result = result & F.col(name).eqNullSafe(F.col(f"_new_{name}"))
    return result
