"""Column listings of the stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "table_schema string, table_name string, position int, column_name string, data_type string, column_comment string"


def schema_columns(
    spark: SparkSession, tables: Mapping[str, DataFrame], namespace: str = "default"
) -> DataFrame:
    """One row per column of the given frames, comments taken from the schema."""
    rows = [
        (namespace, table, i, f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment"))
        for table, df in tables.items()
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def catalog_columns(spark: SparkSession, namespace: str = "default") -> DataFrame:
    """One row per column of the tables and views registered in ``namespace``."""
    rows = [
        (namespace, table.name, i, column.name, column.dataType, column.description)
        for table in spark.catalog.listTables(namespace)
        for i, column in enumerate(spark.catalog.listColumns(table.name), 1)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def _is_cube() -> Column:
    # The name patterns, in which `_` stands for any character.
    return F.col("table_name").like("cube_%") | F.col("table_name").like("inv_cube_%")


def warehouse_columns(columns: DataFrame) -> DataFrame:
    hidden = F.col("table_name").like(".inner%")
    return columns.filter(~hidden & ~_is_cube()).orderBy("table_name", "position")


def cube_columns(columns: DataFrame) -> DataFrame:
    storage = F.col("table_name").like("%_storage")
    return columns.filter(_is_cube() & ~storage).orderBy("table_name", "position")
