"""The five dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.functions.columns import customer_type, date_key, lenient_date, pick
from bazaarcube.operators.joins import join_dim
from bazaarcube.operators.keys import stable_keys
from bazaarcube.schemas import WAREHOUSE
from bazaarcube.sources.operational import Tables


def date_bounds(raw: Tables) -> DataFrame:
    """One row: the earliest and latest date of known customers' orders, product
    updates, store openings and stock entries.

    Each source is reduced to its own bounds before the union. Orders are first
    reduced per customer, so that checking the customers joins one row for each,
    however many orders one of them has.
    """

    def bounds(df: DataFrame, column: str, *by: str) -> DataFrame:
        ngay = lenient_date(F.col(column))
        return df.groupBy(*by).agg(F.min(ngay).alias("lo"), F.max(ngay).alias("hi"))

    known = raw["khachhang"].select(F.col("makh").alias("khachhangmakh"))
    per_customer = bounds(raw["dondathang"], "ngaydathang", "khachhangmakh")
    ordered = per_customer.join(known, "khachhangmakh", "left_semi")
    parts = [
        ordered.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")),
        bounds(raw["mathang"], "ngaycapnhat"),
        bounds(raw["cuahang"], "ngaythanhlapch"),
        bounds(raw["mathang_duoctru"], "thoigiannhap"),
    ]
    return reduce(DataFrame.union, parts).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def dim_thoigian(raw: Tables, known: DataFrame | None = None) -> DataFrame:
    """Every day between the bounds, those of the ``known`` calendar included: at most
    the days of the DATE range used."""
    bounds = date_bounds(raw)
    if known is not None:
        before = known.agg(F.min("ngay").alias("lo"), F.max("ngay").alias("hi"))
        bounds = bounds.union(before).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = bounds.filter("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("ngay"))
    day = F.col("ngay")
    return days.select(
        date_key(day).alias("sk_thoiGian"),
        "ngay",
        F.month(day).alias("thang"),
        F.quarter(day).alias("quy"),
        F.year(day).alias("nam"),
    )


def dim_mathang(raw: Tables, known: DataFrame | None = None) -> DataFrame:
    named = pick(
        raw["mathang"],
        {
            "mamh": "maMH", "tenmh": "tenMH", "mota": "moTa", "kichco": "kichCo",
            "trongluong": "trongLuong", "gia": "gia", "ngaycapnhat": "ngayMoBan",
        },
    )
    return stable_keys(named, "maMH", "sk_matHang", known).select(*WAREHOUSE["Dim_MatHang"].columns)


def dim_diadiem(raw: Tables, known: DataFrame | None = None) -> DataFrame:
    named = pick(
        raw["vanphongdaidien"],
        {
            "matp": "maTP", "mien": "mien", "diachivp": "diaChiVP",
            "ngaythanhlapvp": "ngayThanhLapVP", "tenthanhpho": "tenThanhPho",
        },
    )
    return stable_keys(named, "maTP", "sk_diaDiem", known).select(*WAREHOUSE["Dim_DiaDiem"].columns)


def dim_khachhang(raw: Tables, locations: DataFrame, location_rows: int, known: DataFrame | None = None) -> DataFrame:
    travel = pick(raw["khachhang_dulich"], {"khachhangmakh": "maKH", "hdvdulich": "huongDanVien"})
    postal = pick(raw["khachhang_buudien"], {"khachhangmakh": "maKH", "diachibuudien": "diaChiBuuDien"})
    typed = (
        pick(
            raw["khachhang"],
            {
                "makh": "maKH", "tenkh": "tenKH", "ngaydatdautien": "ngayDatHangDauTien",
                "vanphongdaidienmatp": "maTP",
            },
        )
        .join(travel, "maKH", "left")
        .join(postal, "maKH", "left")
        .withColumn("loaiKhachHang", customer_type(F.col("huongDanVien"), F.col("diaChiBuuDien")))
    )
    placed = join_dim(typed, locations.select("sk_diaDiem", "maTP"), "maTP", "left", location_rows)
    return stable_keys(placed, "maKH", "sk_khachHang", known).select(*WAREHOUSE["Dim_KhachHang"].columns)


def dim_cuahang(raw: Tables, locations: DataFrame, location_rows: int, known: DataFrame | None = None) -> DataFrame:
    named = pick(
        raw["cuahang"],
        {
            "mach": "maCH", "sodienthoai": "soDienThoai", "ngaythanhlapch": "ngayThanhLapCH",
            "vanphongdaidienmatp": "maTP",
        },
    )
    placed = join_dim(named, locations.select("sk_diaDiem", "maTP"), "maTP", "left", location_rows)
    return stable_keys(placed, "maCH", "sk_cuaHang", known).select(*WAREHOUSE["Dim_CuaHang"].columns)
