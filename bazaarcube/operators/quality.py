"""Key, reference and reconciliation checks, each as a distributed query."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarcube.schemas import FOREIGN_KEYS, PRIMARY_KEYS
from bazaarcube.session import stage
from bazaarcube.sources.operational import Tables


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that are repeated or have a NULL part, with their row counts."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("so_dong")).filter((F.col("so_dong") > 1) | any_null)
    )


def primary_key_report(raw: Tables, tables: Iterable[str] = tuple(PRIMARY_KEYS)) -> DataFrame:
    """Per table: how many key values are violated and how many rows they hold."""
    parts = [
        key_violations(raw[table], PRIMARY_KEYS[table])
        .agg(
            F.count(F.lit(1)).alias("so_khoa_loi"),
            F.coalesce(F.sum("so_dong"), F.lit(0)).alias("so_dong_loi"),
        )
        .select(F.lit(table).alias("bang"), "so_khoa_loi", "so_dong_loi")
        for table in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child key values without a parent row, with their row counts.

    The child is grouped first, so a value that fills a third of the table is
    one row by the time it is shuffled for the join. NULL references nothing.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("so_dong"))
    return values.join(parent.select(F.col(key).alias(column)), column, "left_anti")


def foreign_key_report(raw: Tables) -> DataFrame:
    parts = [
        orphans(raw[child], column, raw[parent], key)
        .agg(
            F.count(F.lit(1)).alias("so_khoa_loi"),
            F.coalesce(F.sum("so_dong"), F.lit(0)).alias("so_dong_loi"),
        )
        .select(
            F.lit(child).alias("bang"),
            F.lit(column).alias("cot"),
            F.lit(parent).alias("bang_cha"),
            "so_khoa_loi",
            "so_dong_loi",
        )
        for child, column, parent, key in FOREIGN_KEYS
    ]
    return reduce(DataFrame.unionByName, parts)


def require_unique(raw: Tables, tables: Iterable[str]) -> None:
    """Fail when a key is violated in a table whose rows would multiply others."""
    broken = primary_key_report(raw, tables).filter("so_khoa_loi > 0").select("bang").collect()
    if broken:
        raise ValueError("key violated in: " + ", ".join(sorted(row["bang"] for row in broken)))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows found on one side only, duplicates counted; empty when equal."""
    return (
        left.exceptAll(right).withColumn("phia", F.lit("trai"))
        .unionByName(right.exceptAll(left).withColumn("phia", F.lit("phai")))
    )


#: Helper columns of a reconciliation.
_SIDE, _HASH, _RANGE = "_phia", "_bam", "_khoang"


def _signed(df: DataFrame, key: Sequence[str], side: int) -> DataFrame:
    """Rows with +1 or -1 for their side and the hashes of the row and of its key. A hash
    passes over NULLs, so it also takes where they are."""
    columns = [F.col(c) for c in df.columns]
    return df.select(
        *columns,
        F.lit(side).alias(_SIDE),
        F.xxhash64(*columns, *[c.isNull() for c in columns]).alias(_HASH),
        F.xxhash64(*[F.col(c) for c in key]).alias(_RANGE),
    )


def _range_of(bits: int) -> Column:
    return F.shiftrightunsigned(_RANGE, 64 - bits)


def differing_ranges(rows: DataFrame, bits: int) -> DataFrame:
    """The ranges of the key's hash, by its first ``bits``, whose rows differ between the
    sides. Their checksums are the number of rows and the sum of the row hashes, taken
    with the sign of the side: they do not depend on the order of rows, count repeated
    rows, combine map-side, and are zero where both sides hold the same. (Differing
    ranges pass as equal with a probability of about 2^-64 each.)"""
    halves = {"cao": F.shiftright(_HASH, 32), "thap": F.col(_HASH).bitwiseAND(F.lit((1 << 32) - 1))}
    sums = [F.sum(_SIDE).alias("so"), *[F.sum(F.col(_SIDE) * half).alias(name) for name, half in halves.items()]]
    found = rows.groupBy(_range_of(bits).alias(_RANGE)).agg(*sums)
    return found.filter("so <> 0 OR cao <> 0 OR thap <> 0").select(_RANGE)


def reconcile(left: DataFrame, right: DataFrame, key: Sequence[str], bits: Sequence[int] = (12, 24)) -> DataFrame:
    """Rows of which one side has more, with the side (``phia``: trai or phai) and how many
    more (``soLan``); empty where both sides hold the same rows, repeated ones counted.

    Equal tables cost one scan of each and a shuffle of checksums. Where some of the 2^12
    ranges of the key's hash differ, their rows are looked at again in 2^24 ranges, and
    only rows of finer ranges that differ are shuffled and compared. NULL equals NULL. The
    sides must have the same columns, none of a type without hashes (maps).
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    rows = _signed(left, key, 1).unionByName(_signed(right.select(*left.columns), key, -1))
    for n in bits:
        ranges = stage(differing_ranges(rows, n), "ranges").withColumnRenamed(_RANGE, "_khac")
        # 4,096 numbers at most are sent to all tasks; Spark measures the finer ones
        few = F.broadcast(ranges) if n <= 12 else ranges
        rows = rows.join(few, _range_of(n) == F.col("_khac"), "left_semi")
    more = rows.groupBy(*left.columns).agg(F.sum(_SIDE).alias(_SIDE)).filter(F.col(_SIDE) != 0)
    side = F.when(F.col(_SIDE) > 0, "trai").otherwise("phai")
    return more.select(*left.columns, side.alias("phia"), F.abs(_SIDE).cast("bigint").alias("soLan"))


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` plus the incoming rows whose key is new.

    Of several incoming rows with one key the smallest is kept, so a repeated
    run gives the same table.
    """
    rest = [c for c in existing.columns if c not in key]
    if rest:
        firsts = incoming.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_first"))
        firsts = firsts.select(*key, "_first.*")
    else:
        firsts = incoming.select(*key).distinct()
    new = firsts.join(existing.select(*key), list(key), "left_anti")
    return existing.unionByName(new.select(*existing.columns))
