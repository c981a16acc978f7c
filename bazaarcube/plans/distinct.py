"""Distinct customers as stored sets, which merge where counts do not.

A count of distinct customers cannot be summed over cells or batches, a set can be
united. A *set cube* keeps for each cell the customers with an order in it, beside the
cell's sums:

* exact: bitmaps over the dense surrogate keys. A cell has one bitmap for each block of
  32,768 keys, so a cell with a third of all customers is many rows, which merge in
  many tasks. Counts are exact.
* approximate: one sketch of fixed size for each cell, with a relative standard error of
  about 1.04 / sqrt(2^precision).

Rows without a day keep NULL time columns and rows without a known office the flag
``PLACED`` = false, so that one wide set cube answers every grouping by some of its
columns with exactly the rows that belong to it. Rows without a customer are in no set
and in no sum.

A set cube is a folder of parts: the fact as it was, and later batches. A part appears
under its name when it is complete, and a batch that comes again is left alone.

A bitmap of few customers is a few bytes on its way and 4 KB in a task, so tasks are not
sized by the bytes they read: rows are dealt by the groups they belong to, over as many
tasks as their number asks for, and files hold so many sets at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarcube.operators.joins import fits_broadcast, join_dim, join_packed
from bazaarcube.plans.cubes import PLACE_COLUMNS, PLACED, SUBJECTS, TIME_COLUMNS, label_table, labels_of, with_calendar
from bazaarcube.session import exists, folder_names, move_folder, remove_folder
from bazaarcube.sinks.warehouse import Star

WHAT = SUBJECTS["order"]
CUSTOMER, PRODUCT = WHAT.keys
#: Exact sets that one task merges and one file holds (32 MB as bitmaps), and rows of the
#: fact whose customers one task puts into sets.
TASK_SETS, TASK_ROWS = 1 << 13, 1 << 19
#: Block of customer keys of an exact set, and the set itself (bitmap or sketch).
BLOCK, SET = "_khoi", "_tap"


@dataclass(frozen=True)
class SetCube:
    """``group`` may hold every order column but the customer's id. ``precision`` is
    None for exact sets, else the binary logarithm of a sketch's registers (4 to 21)."""

    group: tuple[str, ...]
    precision: int | None = None

    def __post_init__(self) -> None:
        known = {*TIME_COLUMNS, *PLACE_COLUMNS, "loaiKhachHang", "maMH", "tenMH"}
        if not set(self.group) <= known:
            raise ValueError(f"a set of customers cannot be grouped by {sorted(set(self.group) - known)}")

    @property
    def time(self) -> list[str]:
        return [c for c in self.group if c in TIME_COLUMNS]

    @property
    def placed(self) -> bool:
        return any(c in PLACE_COLUMNS for c in self.group)

    @property
    def cell_columns(self) -> list[str]:
        return [*self.group, *([PLACED] if self.placed else []), *([BLOCK] if self.precision is None else [])]

    def made(self) -> Column:
        if self.precision is None:
            return F.bitmap_construct_agg(F.bitmap_bit_position(CUSTOMER))
        return F.hll_sketch_agg(CUSTOMER, self.precision)

    def merged(self) -> Column:
        return F.bitmap_or_agg(SET) if self.precision is None else F.hll_union_agg(SET)

    def counted(self) -> Column:
        return F.sum(F.bitmap_count(SET)) if self.precision is None else F.hll_sketch_estimate(F.hll_union_agg(SET))


def _dealt(cells: DataFrame, rows: int, each: int, *by: str) -> DataFrame:
    """``cells`` dealt by ``by`` over tasks of about ``each`` of their ``rows``."""
    return cells.repartition(max(1, -(-rows // each)), *by)


def customer_sets(star: Star, cube: SetCube, fact: DataFrame | None = None) -> DataFrame:
    """The cells of ``cube`` over the fact (or the given rows of it).

    Rows are first summed by key, which combines map-side: a hot customer or product is
    a few rows by the time the labels are joined and the sets are built.
    """
    rows = star[WHAT.fact] if fact is None else fact
    rows = rows.filter(F.col(CUSTOMER).isNotNull())
    n = star.rows[WHAT.fact] if fact is None else rows.count()
    if cube.time:
        rows = with_calendar(star, rows, cube.time, "left")
    keys = [k for k in WHAT.keys if k == CUSTOMER or labels_of("order", k, cube.group)]
    cells = rows.groupBy(*cube.time, *keys).agg(*[m.first_sum() for m in WHAT.measures])
    for key in keys:
        labels = labels_of("order", key, cube.group)
        if labels:
            table = WHAT.labels[key][0]
            lookup = label_table(star, "order", key, labels, keep_unplaced=key == CUSTOMER)
            few = not fits_broadcast(lookup, star.rows[table]) and WHAT.labels[key][1][0] not in labels
            if few and (packed := star.packed(lookup, table, key)):
                cells = join_packed(cells, packed, key)
            else:
                cells = join_dim(cells, lookup, key, "inner", star.rows[table])
    if cube.precision is None:
        # dealt as keys: the sets of a task are as wide in its memory, however they pack
        cells = _dealt(cells.withColumn(BLOCK, F.bitmap_bucket_number(CUSTOMER)), n, TASK_ROWS, *cube.cell_columns)
    return cells.groupBy(*cube.cell_columns).agg(cube.made().alias(SET), *[m.merged_sum() for m in WHAT.measures])


def merge_sets(cells: DataFrame, cube: SetCube) -> DataFrame:
    """One row for each cell (and block) out of the rows of several parts."""
    if cube.precision is None:
        cells = _dealt(cells, cells.count(), TASK_SETS, *cube.cell_columns)
    return cells.groupBy(*cube.cell_columns).agg(cube.merged().alias(SET), *[m.merged_sum() for m in WHAT.measures])


def distinct_customers(cells: DataFrame, cube: SetCube, group: Sequence[str]) -> DataFrame:
    """Distinct customers and sums by ``group``, some of the cube's columns.

    Exact sets are united for each block, in as many tasks as there are groups and
    blocks; only the counts of the blocks are summed.
    """
    if not set(group) <= set(cube.group):
        raise LookupError(f"the set cube by {list(cube.group)} does not answer {list(group)}")
    if any(c in TIME_COLUMNS for c in group):
        cells = cells.filter(F.col(next(c for c in group if c in TIME_COLUMNS)).isNotNull())
    if any(c in PLACE_COLUMNS for c in group):
        cells = cells.filter(PLACED)
    if cube.precision is None:
        cells = _dealt(cells, cells.count(), TASK_SETS, *group, BLOCK)
        cells = cells.groupBy(*group, BLOCK).agg(cube.merged().alias(SET), *[m.merged_sum() for m in WHAT.measures])
    found = cells.groupBy(*group).agg(cube.counted().alias("soKhachHang"), *[m.merged_sum() for m in WHAT.measures])
    if not group:  # no rows: the count of an empty set
        found = found.withColumn("soKhachHang", F.coalesce("soKhachHang", F.lit(0).cast("bigint")))
    return found.select(*group, "soKhachHang", *[m.report() for m in WHAT.measures])


# --- stored set cubes ----------------------------------------------------------

BACKFILL, STREAM, COMPACTED = "backfill", "stream", "compacted"


def _part(origin: str, batch_id: int) -> str:
    return f"{origin}-{batch_id:012d}"


def _land(spark: SparkSession, cells: DataFrame, path: str, part: str) -> None:
    """Store the cells as a part, unless it is there already."""
    if exists(spark, f"{path}/{part}"):
        return
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    cells.write.option("maxRecordsPerFile", TASK_SETS).parquet(draft)
    if not move_folder(spark, draft, f"{path}/{part}"):
        remove_folder(spark, draft)


def store_sets(star: Star, cube: SetCube, path: str) -> None:
    """The sets of the fact as it is now. Batches hold rows that arrive after this."""
    _land(star.spark, customer_sets(star, cube), path, _part(BACKFILL, 0))


def compacted_upto(spark: SparkSession, path: str) -> int:
    """The last batch that a compaction has folded in; -1 if there is none."""
    return max((int(n.split("-")[1]) for n in folder_names(spark, path) if n.startswith(COMPACTED)), default=-1)


def add_batch(star: Star, cube: SetCube, rows: DataFrame, path: str, batch_id: int) -> None:
    """The sets of one batch of fact rows; a batch that is stored or folded in is skipped."""
    if batch_id > compacted_upto(star.spark, path):
        _land(star.spark, customer_sets(star, cube, rows), path, _part(STREAM, batch_id))


def start_set_stream(
    star: Star, facts: DataFrame, cube: SetCube, path: str, checkpoint: str, available_now: bool = False, every: str = "1 minute"
) -> StreamingQuery:
    writer = facts.writeStream.foreachBatch(lambda rows, batch_id: add_batch(star, cube, rows, path, batch_id))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


def live_parts(spark: SparkSession, path: str) -> list[str]:
    """The parts that count: the newest compaction, and the batches after it. Parts that
    it has folded in do not count, whether they are still there or not."""
    names = [n for n in folder_names(spark, path) if n.startswith((BACKFILL, STREAM, COMPACTED))]
    upto = compacted_upto(spark, path)
    if upto < 0:
        return sorted(names)
    return [_part(COMPACTED, upto), *sorted(n for n in names if n.startswith(STREAM) and int(n.split("-")[1]) > upto)]


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the parts that count now."""
    return spark.read.parquet(*[f"{path}/{name}" for name in live_parts(spark, path)])


def compact_sets(spark: SparkSession, cube: SetCube, path: str, committed: int) -> None:
    """Fold the parts up to the batch ``committed``, the last one that the checkpoint of
    the stream has committed, into one. The stream may go on meanwhile: the new part
    takes the place of the old ones in the step that gives it its name, and a reader
    has chosen its parts before or after it. The folded parts stay for readers that are
    still at work, until ``drop_folded``."""
    parts = [n for n in live_parts(spark, path) if not n.startswith(STREAM) or int(n.split("-")[1]) <= committed]
    if committed > compacted_upto(spark, path) and parts:
        rows = spark.read.parquet(*[f"{path}/{name}" for name in parts])
        _land(spark, merge_sets(rows, cube), path, _part(COMPACTED, committed))


def drop_folded(spark: SparkSession, path: str) -> list[str]:
    """Delete the parts that a compaction has replaced; returns their names."""
    live = set(live_parts(spark, path))
    folded = [n for n in folder_names(spark, path) if n.startswith((BACKFILL, STREAM, COMPACTED)) and n not in live]
    for name in folded:
        remove_folder(spark, f"{path}/{name}")
    return sorted(folded)
