"""The nine operational tables and the extracts taken from them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.functions.columns import lower_columns
from bazaarcube.schemas import SOURCE_SCHEMAS

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class JdbcSplit:
    """A numeric or date column that splits a JDBC read over ``parts`` tasks."""

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class SourceConfig:
    """Where the operational tables are: a JDBC database or a folder per table."""

    format: str
    location: str
    namespace: str = "idb"
    options: dict[str, str] = field(default_factory=dict)
    splits: dict[str, JdbcSplit] = field(default_factory=dict)
    #: Conditions that cut a table into parts, one task each, where no number or date
    #: splits it (``hash_predicates`` writes them for a text key).
    predicates: dict[str, list[str]] = field(default_factory=dict)

    def reader_options(self, table: str) -> dict[str, str]:
        if self.format != "jdbc":
            return dict(self.options)
        split = self.splits.get(table)
        return {
            "url": self.location,
            "dbtable": f"{self.namespace}.{table}",
            **self.options,
            **(split.options() if split else {}),
        }


#: Tables too large to read over one connection.
SPLIT_TABLES = ("mathang_duocdat", "mathang_duoctru")


def hash_predicates(expression: str, parts: int) -> list[str]:
    """Conditions for ``parts`` equal parts; ``expression`` is an integer hash of the
    key in the database's SQL, such as ``hashtext(dondathangmadon)``."""
    return [f"MOD(ABS({expression}), {parts}) = {i}" for i in range(parts)]


def read_table(spark: SparkSession, conf: SourceConfig, table: str) -> DataFrame:
    reader = spark.read.format(conf.format).options(**conf.reader_options(table))
    if conf.format == "jdbc":
        parts = conf.predicates.get(table)
        if table in SPLIT_TABLES and not parts and table not in conf.splits:
            raise ValueError(f"{table} needs a split or predicates: one task would read all of it")
        if parts:
            options = conf.reader_options(table)
            df = spark.read.jdbc(options.pop("url"), options.pop("dbtable"), predicates=parts, properties=options)
        else:
            df = reader.load()
    else:
        if conf.format in ("csv", "json"):
            # A value that does not fit its column stops the load.
            reader = reader.schema(SOURCE_SCHEMAS[table]).option("mode", "FAILFAST")
        df = reader.load(f"{conf.location.rstrip('/')}/{table}")
    return lower_columns(df).select(*SOURCE_SCHEMAS[table].names)


def load_sources(spark: SparkSession, conf: SourceConfig) -> Tables:
    """All nine tables, lazily; column lists reach the scan."""
    return {table: read_table(spark, conf, table) for table in SOURCE_SCHEMAS}


def order_extract(raw: Tables) -> DataFrame:
    """Orders of known customers, with the customer's name and office."""
    customers = raw["khachhang"].select(
        F.col("makh").alias("khachhangmakh"), "tenkh", "vanphongdaidienmatp"
    )
    return (
        raw["dondathang"]
        .join(customers, "khachhangmakh", "inner")
        .select("madon", "ngaydathang", "khachhangmakh", "tenkh", "vanphongdaidienmatp")
    )


def order_line_extract(raw: Tables) -> DataFrame:
    """Order lines of known products and orders, with both sides' attributes."""
    products = raw["mathang"].select(
        F.col("mamh").alias("mathangmamh"), "tenmh", "mota", "kichco", "trongluong"
    )
    orders = raw["dondathang"].select(
        F.col("madon").alias("dondathangmadon"), "ngaydathang", "khachhangmakh"
    )
    return (
        raw["mathang_duocdat"]
        .join(products, "mathangmamh", "inner")
        .join(orders, "dondathangmadon", "inner")
        .select(
            "soluongdat", "giadat", "mathangmamh", "dondathangmadon",
            "tenmh", "mota", "kichco", "trongluong", "ngaydathang", "khachhangmakh",
        )
    )


def extract(raw: Tables) -> Tables:
    """The nine extracts: seven plain selects and the two joined ones."""
    return {**raw, "dondathang": order_extract(raw), "mathang_duocdat": order_line_extract(raw)}


def table_counts(tables: Tables) -> DataFrame:
    """One row per table: its name and row count, in a single job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("so_dong")).select(F.lit(name).alias("bang"), "so_dong")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result
