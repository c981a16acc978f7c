from __future__ import annotations

import datetime as dt

from bazaarcube.functions.describe import (
    CUBE_ATTRIBUTE, CUBE_MEASURE, DESCRIPTIONS, DW_ATTRIBUTE, DW_KEY, DW_MEASURE,
)
from bazaarcube.plans.cubes import CUBES, build_cube
from bazaarcube.plans.dictionary import data_dictionary, export_dictionary
from bazaarcube.session import new_folder
from bazaarcube.sources.catalog import catalog_columns, cube_columns, schema_columns, warehouse_columns


def test_warehouse_dictionary(spark, edge_star):
    rows = data_dictionary(spark, {**edge_star.tables, "cube_0d": edge_star["Dim_DiaDiem"]}, "dw").collect()
    assert len(rows) == 5 + 8 + 6 + 5 + 8 + 7 + 4
    roles = {(r["table_name"], r["column_name"]): r["role"] for r in rows}
    assert roles["Dim_MatHang", "gia"] == roles["Fact_DonDatHang", "thanhTien"] == DW_MEASURE
    assert roles["Fact_DonDatHang", "giaDat"] == DW_ATTRIBUTE
    assert roles["Fact_TonKho", "sk_cuaHang"] == DW_KEY
    texts = {r["column_name"]: r["column_comment"] for r in rows}
    assert texts["maKH"] == DESCRIPTIONS["maKH"] and texts["maDon"] == "Thuộc tính phân tích"


def test_cube_dictionary_and_export(spark, golden_star):
    cubes = {n: build_cube(golden_star, CUBES[n]) for n in ("cube_1d_bang", "inv_cube_1d_nam")}
    hidden = {"cube_1d_bang_storage": cubes["cube_1d_bang"], "Dim_X": golden_star["Dim_DiaDiem"]}
    dictionary = data_dictionary(spark, {**cubes, **hidden}, "cube")
    assert [(r["table_name"], r["column_name"], r["role"]) for r in dictionary.collect()] == [
        ("cube_1d_bang", "mien", CUBE_ATTRIBUTE),
        ("cube_1d_bang", "tongDoanhThu", CUBE_MEASURE),
        ("cube_1d_bang", "tongSoLuong", CUBE_MEASURE),
        ("inv_cube_1d_nam", "nam", CUBE_ATTRIBUTE),
        ("inv_cube_1d_nam", "tongTonKho", CUBE_MEASURE),
    ]
    path = new_folder(spark, "dictionary")
    export_dictionary(dictionary, "cube", path, dt.datetime(2025, 1, 1))
    assert spark.read.csv(f"{path}/csv", header=True).count() == 5
    text = "\n".join(r[0] for r in spark.read.text(f"{path}/markdown").coalesce(1).collect())
    assert text.startswith("# Từ Điển OLAP Cubes (Cube Metadata)")
    section = text.split("### Bảng Cube/Materialized View: `cube_1d_bang`")[1].split("###")[0].strip().splitlines()
    assert section[1:] == [
        "|---|---|---|---|",
        "| mien | string | Dimension Attribute (Chiều phân tích) | Miền / Bang khu vực |",
        "| tongDoanhThu | double | Measure (Đo lường, Tổng/Đếm) | Tổng doanh thu bán hàng sau khi quy đổi |",
        "| tongSoLuong | bigint | Measure (Đo lường, Tổng/Đếm) | Tổng số lượng hàng hóa được đặt |",
    ]


def test_comments_win(spark):
    from bazaarcube.plans.dictionary import data_dictionary as make

    df = spark.range(1).selectExpr("id AS nam", "id AS quy")
    df = df.withMetadata("nam", {"comment": "own words"}).withMetadata("quy", {"comment": "  "})
    assert [r["column_comment"] for r in make(spark, {"t": df}, "dw").collect()] == ["own words", "Quý"]


def test_catalog_listing(spark, golden_star):
    golden_star["Fact_TonKho"].createOrReplaceTempView("fact_probe")
    golden_star["Fact_TonKho"].createOrReplaceTempView("cube_probe")
    columns = catalog_columns(spark)
    assert warehouse_columns(columns).filter("table_name = 'fact_probe'").count() == 4
    assert cube_columns(columns).filter("table_name = 'cube_probe'").count() == 4
    assert warehouse_columns(columns).filter("table_name = 'cube_probe'").isEmpty()
    assert schema_columns(spark, {"t": golden_star["Fact_TonKho"]}).first()["position"] == 1
