"""Building the warehouse tables from the operational ones."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.operators.dims import dim_cuahang, dim_diadiem, dim_khachhang, dim_mathang, dim_thoigian
from bazaarcube.operators.facts import fact_dondathang, fact_tonkho
from bazaarcube.operators.joins import join_dim
from bazaarcube.schemas import LOAD_ORDER
from bazaarcube.session import new_folder
from bazaarcube.sinks.warehouse import Star, open_table, stored_rows, write_table
from bazaarcube.sources.operational import Tables
from bazaarcube.sources.testdata import sources_from_testdata


def build_star(spark: SparkSession, raw: Tables, path: str) -> Star:
    """Build and store the seven tables under ``path``.

    Each dimension is stored before the tables that look up its keys, so its
    keys are fixed, its size is known, and lookups read two narrow columns.
    Tables that do not depend on each other are sent to Spark together.
    """

    def store(name: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, int]:
        df = build()
        write_table(df, name, path)
        stored = open_table(spark, path, name, df.schema)
        return stored, stored_rows(stored)

    with ThreadPoolExecutor(3) as pool:
        calendar = pool.submit(store, "Dim_ThoiGian", lambda: dim_thoigian(raw))
        places = pool.submit(store, "Dim_DiaDiem", lambda: dim_diadiem(raw))
        items = pool.submit(store, "Dim_MatHang", lambda: dim_mathang(raw))
        buyers = pool.submit(store, "Dim_KhachHang", lambda: dim_khachhang(raw, *places.result()))
        shops = pool.submit(store, "Dim_CuaHang", lambda: dim_cuahang(raw, *places.result()))
        orders = pool.submit(
            store, "Fact_DonDatHang", lambda: fact_dondathang(raw, *buyers.result(), *items.result())
        )
        stock = pool.submit(
            store, "Fact_TonKho", lambda: fact_tonkho(raw, *items.result(), *shops.result())
        )
        results = dict(
            zip(LOAD_ORDER, [f.result() for f in (calendar, places, items, buyers, shops, orders, stock)])
        )
    return Star({name: df for name, (df, _) in results.items()}, {name: n for name, (_, n) in results.items()})


_opened: dict[tuple[str, str], Star] = {}


def star_for_testdata(spark: SparkSession, sf_dir: str) -> Star:
    """The star of one input folder, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _opened:
        _opened[key] = build_star(spark, sources_from_testdata(spark, sf_dir), new_folder(spark, "star"))
    return _opened[key]


def store_view(star: Star) -> DataFrame:
    """Stores with their office's city and region (left: a store without a known
    office stays)."""
    return _with_office(star["Dim_CuaHang"], star)


def customer_view(star: Star) -> DataFrame:
    """Customers with their office's city and region."""
    return _with_office(star["Dim_KhachHang"], star)


def _with_office(dim: DataFrame, star: Star) -> DataFrame:
    offices = star["Dim_DiaDiem"].select("sk_diaDiem", "maTP", "tenThanhPho", "mien", "diaChiVP")
    return join_dim(dim, offices, "sk_diaDiem", "left", star.rows["Dim_DiaDiem"])


def with_day_names(calendar: DataFrame) -> DataFrame:
    return calendar.withColumn("thu", F.date_format("ngay", "EEEE"))
