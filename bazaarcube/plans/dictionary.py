"""Data dictionaries of the warehouse tables and of the cubes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.functions.describe import cube_role, description, warehouse_role
from bazaarcube.sources.catalog import cube_columns, schema_columns, warehouse_columns


@dataclass(frozen=True)
class Layout:
    title: str
    heading: str
    header: str


# The text of the Markdown dictionaries.
LAYOUTS: dict[str, Layout] = {
    "dw": Layout(
        "# Từ Điển Kho Dữ Liệu (Technical Metadata - Data Warehouse)",
        "### Bảng DW: ",
        "| Tên Cột | Kiểu Dữ Liệu (Spark) | Vai Trò (Mapping/Surrogate/Measure) | Ghi Chú |",
    ),
    "cube": Layout(
        "# Từ Điển OLAP Cubes (Cube Metadata)",
        "### Bảng Cube/Materialized View: ",
        "| Tên Cột | Kiểu Dữ Liệu | Vai Trò (Dimension/Measure) | Mô Tả Ý Nghĩa Nghiệp Vụ |",
    ),
}


def data_dictionary(spark: SparkSession, tables: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """Schema, table, column, type, description and role, in table and column
    order. ``kind`` is ``dw`` or ``cube``."""
    columns = schema_columns(spark, tables)
    name = F.col("column_name")
    if kind == "dw":
        listed, role = warehouse_columns(columns), warehouse_role(name)
    else:
        listed, role = cube_columns(columns), cube_role(name)
    return listed.select(
        "table_schema",
        "table_name",
        "position",
        "column_name",
        "data_type",
        description(F.col("column_comment"), name).alias("column_comment"),
        role.alias("role"),
    )


def markdown(dictionary: DataFrame, kind: str, at: datetime) -> DataFrame:
    """The dictionary as Markdown: one section per table, one row per section.

    A dictionary holds one row per column of the tables, so it is small by nature.
    """
    layout = LAYOUTS[kind]
    line = F.concat(
        F.lit("| "), F.concat_ws(" | ", "column_name", "data_type", "role", "column_comment"), F.lit(" |")
    )
    sections = (
        dictionary.groupBy("table_name")
        .agg(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))).alias("lines"))
        .select(
            "table_name",
            F.concat_ws(
                "\n",
                F.concat(F.lit(layout.heading + "`"), "table_name", F.lit("`")),
                F.lit(layout.header),
                F.lit("|---|---|---|---|"),
                F.array_join("lines.line", "\n"),
                F.lit(""),
            ).alias("value"),
        )
    )
    title = f"{layout.title}\n*Được tạo tự động vào lúc: {at:%Y-%m-%d %H:%M:%S}*\n"
    head = dictionary.sparkSession.createDataFrame([("", title)], "table_name string, value string")
    return head.unionByName(sections).orderBy("table_name").select("value")


def export_dictionary(dictionary: DataFrame, kind: str, path: str, at: datetime) -> None:
    """Write the CSV and the Markdown form, each as one file (small, see above)."""
    (
        dictionary.orderBy("table_name", "position")
        .drop("position")
        .coalesce(1)
        .write.mode("overwrite")
        .csv(f"{path}/csv", header=True)
    )
    markdown(dictionary, kind, at).coalesce(1).write.mode("overwrite").text(f"{path}/markdown")
