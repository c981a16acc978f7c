from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarcube.operators.dims import dim_thoigian
from bazaarcube.operators.facts import daily_close, fact_dondathang, quarantine
from bazaarcube.plans.star import build_star, customer_view, store_view
from bazaarcube.schemas import FACT_KEYS, WAREHOUSE
from bazaarcube.session import new_folder
from bazaarcube.sinks.warehouse import load_star, open_star, row_counts
from bazaarcube.sources.operational import extract, table_counts
from tests.conftest import source_frames, values


def test_table_layouts(edge_star):
    for name, layout in WAREHOUSE.items():
        assert edge_star[name].schema.names == layout.columns
        assert [f.dataType for f in edge_star[name].schema] == [f.dataType for f in layout.schema]


def test_calendar_spans_all_four_sources(edge_raw, edge_star):
    calendar = edge_star["Dim_ThoiGian"]
    lo, hi, n = calendar.agg(F.min("ngay"), F.max("ngay"), F.count("*")).first()
    # The earliest day is a store opening. Later orders have no known customer,
    # so the latest day is that of the last order whose customer is known.
    assert (lo, hi) == (dt.date(2024, 1, 15), dt.date(2025, 2, 15))
    assert n == (hi - lo).days + 1
    leap = calendar.filter("sk_thoiGian = 20240229").first()
    assert (leap["ngay"], leap["thang"], leap["quy"], leap["nam"]) == (dt.date(2024, 2, 29), 2, 1, 2024)


def test_calendar_of_no_dates_is_empty(spark):
    assert dim_thoigian(source_frames(spark)).count() == 0


def test_customers(edge_star):
    rows = {r["maKH"]: r for r in edge_star["Dim_KhachHang"].collect()}
    assert {k: (r["sk_khachHang"], r["loaiKhachHang"]) for k, r in rows.items()} == {
        "KH00001": (1, "Du lich"), "KH00002": (2, "Buu dien"), "KH00003": (3, "Ca hai"),
        "KH00004": (4, "Khong phan loai"), "KH00005": (5, "Khong phan loai"), "KH00006": (6, "Khong phan loai"),
    }
    assert rows["KH00005"]["sk_diaDiem"] is None and rows["KH00006"]["sk_diaDiem"] is None
    assert rows["KH00001"]["ngayDatHangDauTien"] == dt.date(2024, 12, 31)


def test_nan_is_stored_as_null(edge_star):
    weights = {r["maMH"]: r["trongLuong"] for r in edge_star["Dim_MatHang"].collect()}
    assert weights == {"MH0001": 0.5, "MH0002": None, "MH0003": None}


def test_order_fact(edge_star):
    fact = values(edge_star["Fact_DonDatHang"], "maDon", "sk_matHang", "sk_khachHang", "sk_thoiGian", "thanhTien")
    d = Decimal
    assert fact == [
        ("DON001", 1, 1, 20240229, d("1.00")), ("DON001", 2, 1, 20240229, d("1.00")),
        ("DON002", 3, 2, 20241231, d("59.97")), ("DON003", 1, 3, 20250101, d("0.00")),
        ("DON003", 2, 3, 20250101, d("14.50")), ("DON004", 1, None, 20250228, d("6.00")),
        ("DON005", 1, 4, None, d("15.00")), ("DON006", 3, 5, 20250201, d("23.31")),
        ("DON007", 2, None, 20250301, d("32.00")), ("DON008", 2, 6, 20250215, d("54.00")),
    ]


def test_order_fact_equals_the_extract_with_lookups(edge_raw, edge_star):
    lines = extract(edge_raw)["mathang_duocdat"]
    composed = (
        lines.join(edge_star["Dim_KhachHang"], F.col("khachhangmakh") == F.col("maKH"), "left")
        .join(edge_star["Dim_MatHang"], F.col("mathangmamh") == F.col("maMH"), "left")
        .select("sk_khachHang", "sk_matHang", F.col("dondathangmadon").alias("maDon"), "soluongdat", "giadat")
    )
    stored = edge_star["Fact_DonDatHang"].select("sk_khachHang", "sk_matHang", "maDon", "soLuongDat", "giaDat")
    assert values(composed) == values(stored)


def test_order_fact_without_broadcast(edge_raw, edge_star, tiny_broadcast):
    fact = fact_dondathang(edge_raw, edge_star["Dim_KhachHang"], 6, edge_star["Dim_MatHang"], 3)
    assert values(fact) == values(edge_star["Fact_DonDatHang"])


def test_stock_fact(edge_star):
    assert values(edge_star["Fact_TonKho"]) == [
        (None, 3, 2, 5),
        (20250115, None, 2, 40), (20250115, 1, 1, 70), (20250115, 2, 2, 0), (20250115, 2, 3, 30),
        (20250116, 1, 1, 20), (20250201, 3, 2, 25), (20250201, 3, 4, 15),
    ]


def test_close_by_timestamp_takes_the_last_not_the_largest(spark):
    rows = [("m", "c", dt.datetime(2025, 1, 1, 8), 90), ("m", "c", dt.datetime(2025, 1, 1, 20), 10)]
    stock = spark.createDataFrame(rows, "maMH string, maCH string, thoiGianNhap timestamp, soLuongTonKho int")
    assert values(daily_close(stock)) == [("m", "c", 20250101, 10)]


def test_quarantine_tells_the_reason(edge_star):
    lost = quarantine(edge_star["Fact_DonDatHang"], list(FACT_KEYS["Fact_DonDatHang"]))
    assert values(lost, "maDon", "lyDo") == [
        ("DON004", "missing sk_khachHang"), ("DON005", "missing sk_thoiGian"), ("DON007", "missing sk_khachHang"),
    ]


def test_views_keep_rows_without_office(edge_star):
    assert store_view(edge_star).filter("maCH = 'CH003'").first()["tenThanhPho"] is None
    assert customer_view(edge_star).count() == 6


def test_loading_twice_changes_nothing(spark, edge_star):
    path = new_folder(spark, "twice")
    assert load_star(edge_star.tables, path) == []
    assert load_star(edge_star.tables, path) == []
    again = open_star(spark, path)
    assert again.rows == edge_star.rows
    assert values(again["Fact_TonKho"]) == values(edge_star["Fact_TonKho"])
    assert load_star({"Dim_DiaDiem": edge_star["Dim_DiaDiem"]}, path)[0] == "Dim_ThoiGian"


def test_counts(edge_raw, edge_star):
    assert {r["bang"]: r["so_dong"] for r in row_counts(edge_star).collect()} == edge_star.rows
    extracted = {r["bang"]: r["so_dong"] for r in table_counts(extract(edge_raw)).collect()}
    assert (extracted["dondathang"], extracted["mathang_duocdat"]) == (6, 10)


def test_a_hot_order_and_customer(spark):
    """A third of the lines belongs to one order, product and customer."""
    n = 3000
    price = Decimal("1.01")
    raw = source_frames(
        spark,
        vanphongdaidien=[("T", "t", None, "m", None)],
        mathang=[(f"M{i}", "x", None, None, None, None, None) for i in range(3)],
        khachhang=[(f"K{i}", "x", None, "T") for i in range(3)],
        dondathang=[(f"D{i}", dt.date(2025, 1, 1), f"K{i}") for i in range(3)],
        mathang_duocdat=[(1, price, f"M{i % 3}", "D0" if i % 3 else f"D{i % 2}") for i in range(n)],
    )
    star = build_star(spark, raw, new_folder(spark, "hot"))
    assert star.rows["Fact_DonDatHang"] == n
    assert star["Fact_DonDatHang"].agg(F.sum("thanhTien")).first()[0] == price * n


@pytest.mark.parametrize("table", ["Fact_DonDatHang", "Fact_TonKho"])
def test_facts_are_sorted_within_files(spark, edge_star, table):
    key = WAREHOUSE[table].sort_key[0]
    parts = edge_star[table].select(key, F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"))
    by_file: dict[str, list] = {}
    for r in sorted(parts.collect(), key=lambda r: r["i"]):
        by_file.setdefault(r["f"], []).append(r[key] or 0)
    assert all(rows == sorted(rows) for rows in by_file.values())
