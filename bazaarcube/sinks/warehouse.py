"""Writing and opening the seven warehouse tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaarcube.functions.columns import key_month, key_year, nan_to_null
from bazaarcube.operators.joins import pack_labels
from bazaarcube.operators.quality import key_violations
from bazaarcube.schemas import LOAD_ORDER, WAREHOUSE
from bazaarcube.session import folder_names, read_pointer, remove_folder, write_pointer
from bazaarcube.sources.operational import table_counts

# The year a fact row falls in: its folder on disk, not a column of the table.
YEAR = "nam_ghi"
#: Complete stars by version, and the file that names the one to read.
VERSIONS, POINTER = "versions", "CURRENT"
#: The file of a version that names the folders its tables consist of.
MANIFEST = "TABLES"


@dataclass(frozen=True)
class Part:
    """A folder of a table, by its place in the warehouse; of a fact, the years of it
    that count (None stands for rows without a day; no list for the whole folder)."""

    folder: str
    years: tuple[int | None, ...] | None = None

    def only(self, keep: list[int | None]) -> Part:
        return Part(self.folder, tuple(y for y in keep if self.years is None or y in self.years))


@dataclass(frozen=True)
class Star:
    """The stored warehouse tables with their row counts.

    The counts are those of the verification after the load; they decide which
    dimensions are small enough to broadcast.
    """

    tables: dict[str, DataFrame]
    rows: dict[str, int]
    _unique: dict[tuple[str, str], bool] = field(default_factory=dict, compare=False, repr=False)
    _packed: dict[tuple, tuple[DataFrame, DataFrame] | None] = field(default_factory=dict, compare=False, repr=False)
    _packing: Lock = field(default_factory=Lock, compare=False, repr=False)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def is_unique(self, table: str, column: str) -> bool:
        """Whether a dimension's id names one row; looked up once per star."""
        if (table, column) not in self._unique:
            self._unique[table, column] = key_violations(self[table], (column,)).isEmpty()
        return self._unique[table, column]

    def packed(self, lookup: DataFrame, table: str, key: str, ids: Sequence[str] = ()) -> tuple[DataFrame, DataFrame] | None:
        """``lookup`` (a dimension's key, some of its labels, and perhaps its id) packed for a
        broadcast, if it can be; made once per star."""
        name = (table, *lookup.columns)
        with self._packing:
            if name not in self._packed:
                self._packed[name] = pack_labels(lookup, key, self.rows[table], ids)
            return self._packed[name]

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.tables.values())).sparkSession


def write_table(df: DataFrame, name: str, path: str) -> None:
    """Replace one table. Facts get a folder per year; adaptive execution sizes
    their files: a busy month is split, quiet months are put together."""
    layout = WAREHOUSE[name]
    clean = nan_to_null(df.select(*layout.columns))
    if name.startswith("Fact_"):
        day = F.col("sk_thoiGian")
        (
            clean.withColumns({YEAR: key_year(day), "_month": key_month(day)})
            .hint("rebalance", F.col(YEAR), F.col("_month"))
            .sortWithinPartitions(YEAR, *layout.sort_key)
            .drop("_month")
            .write.mode("overwrite")
            .partitionBy(YEAR)
            .parquet(f"{path}/{name}")
        )
    else:
        # A dimension comes out of its key assignment in key order, so its files
        # already hold separate key ranges and need no shuffle.
        clean.sortWithinPartitions(*layout.sort_key).write.mode("overwrite").parquet(f"{path}/{name}")


def open_table(spark: SparkSession, path: str, name: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/{name}").select(*WAREHOUSE[name].columns)


def fact_rows(spark: SparkSession, path: str, parts: list[Part], schema: StructType | None = None) -> DataFrame:
    """The rows of a table's parts; of a fact with the year they are stored by, which
    prunes folders. Parts of a fact without rows have no folders and are passed over."""
    name = parts[0].folder.split("/")[-1]
    if name.startswith("Fact_"):
        parts = [p for p in parts if any(n.startswith(f"{YEAR}=") for n in folder_names(spark, f"{path}/{p.folder}"))]
        if not parts:
            return spark.createDataFrame([], WAREHOUSE[name].schema).withColumn(YEAR, F.lit(None).cast("int"))

    def read(part: Part) -> DataFrame:
        reader = spark.read if schema is None else spark.read.schema(schema)
        rows = reader.parquet(f"{path}/{part.folder}")
        if part.years is None:
            return rows
        days = [y for y in part.years if y is not None]
        counts = F.col(YEAR).isin(days) if days else F.lit(False)
        return rows.filter(counts | F.col(YEAR).isNull() if None in part.years else counts)

    return reduce(DataFrame.unionByName, [read(p) for p in parts])


def write_manifest(spark: SparkSession, path: str, version: str, parts: dict[str, list[Part]]) -> None:
    write_pointer(spark, f"{path}/{VERSIONS}/{version}/{MANIFEST}", json.dumps({t: [asdict(p) for p in ps] for t, ps in parts.items()}))


def read_manifest(spark: SparkSession, path: str, version: str) -> dict[str, list[Part]]:
    """The parts of each table; a version without a manifest holds all of them itself."""
    text = read_pointer(spark, f"{path}/{VERSIONS}/{version}/{MANIFEST}")
    if text is None:
        return {name: [Part(f"{VERSIONS}/{version}/{name}")] for name in LOAD_ORDER}
    return {
        t: [Part(p["folder"], None if p["years"] is None else tuple(p["years"])) for p in ps] for t, ps in json.loads(text).items()
    }


def stored_rows(df: DataFrame) -> int:
    """Row count of a stored table, answered from the file footers."""
    return df.count()


def current_version(spark: SparkSession, path: str) -> str:
    """The folder of the star that the warehouse points to; the warehouse itself where
    tables were loaded without versions."""
    name = read_pointer(spark, f"{path}/{POINTER}")
    return f"{path}/{VERSIONS}/{name}" if name else path


def publish_version(spark: SparkSession, path: str, name: str, keep: int = 2) -> None:
    """Point the warehouse to a complete version, in one step, and remove versions
    older than the last ``keep`` of which these use no folder."""
    write_pointer(spark, f"{path}/{POINTER}", name)
    versions = sorted(folder_names(spark, f"{path}/{VERSIONS}"))
    kept = {name, *versions[-keep:]}
    used = {p.folder.split("/")[1] for v in kept for parts in read_manifest(spark, path, v).values() for p in parts}
    for old in versions:
        if old not in kept | used:
            remove_folder(spark, f"{path}/{VERSIONS}/{old}")


def open_star(spark: SparkSession, path: str) -> Star:
    version = read_pointer(spark, f"{path}/{POINTER}")
    if version:
        parts = read_manifest(spark, path, version)
        tables = {name: fact_rows(spark, path, parts[name]).select(*WAREHOUSE[name].columns) for name in LOAD_ORDER}
    else:
        tables = {name: open_table(spark, path, name) for name in LOAD_ORDER}
    rows = {row["bang"]: row["so_dong"] for row in table_counts(tables).collect()}
    return Star(tables, rows)


def load_star(star: dict[str, DataFrame], path: str) -> list[str]:
    """Full refresh: replace the given tables, dimensions first.

    Returns the names of the tables that were not given.
    """
    for name in LOAD_ORDER:
        if name in star:
            write_table(star[name], name, path)
    return [name for name in LOAD_ORDER if name not in star]


def row_counts(star: Star) -> DataFrame:
    return table_counts(star.tables)
