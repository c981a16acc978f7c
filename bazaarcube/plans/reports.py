"""The business reports, over the warehouse tables.

Each report states its own order; money is summed exactly and reported as
DOUBLE. Large sides are grouped by their surrogate keys before they are joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarcube.functions.columns import BOTH, POSTAL, TRAVEL
from bazaarcube.operators.joins import join_dim
from bazaarcube.plans.cubes import with_calendar
from bazaarcube.plans.distinct import SetCube, distinct_customers
from bazaarcube.plans.star import customer_view, store_view
from bazaarcube.schemas import WAREHOUSE
from bazaarcube.sinks.warehouse import Star


def _revenue() -> Column:
    return F.sum("thanhTien").cast("decimal(38,2)")


def _join(star: Star, left: DataFrame, dim: DataFrame, table: str, how: str = "inner") -> DataFrame:
    """Join a projection of ``table`` on its surrogate key."""
    return join_dim(left, dim, dim.columns[0], how, star.rows[table])


def _on_sale(star: Star) -> DataFrame:
    return star["Fact_TonKho"].filter(F.col("soLuongTonKho") > 0)


def preview(star: Star, table: str, rows: int = 5) -> DataFrame:
    """The first rows of a table by its sort key."""
    return star[table].orderBy(*WAREHOUSE[table].sort_key).limit(rows)


def revenue_by_month(star: Star) -> DataFrame:
    fact = with_calendar(star, star["Fact_DonDatHang"], ("thang", "nam"))
    return (
        fact.groupBy("thang", "nam")
        .agg(_revenue().cast("double").alias("tongDoanhThu"))
        .orderBy("nam", "thang")
    )


def top_products(star: Star, n: int = 10) -> DataFrame:
    """The ``n`` products with the most revenue; equal revenue is ordered by id."""
    sums = (
        star["Fact_DonDatHang"]
        .groupBy("sk_matHang")
        .agg(_revenue().alias("tongTien"), F.sum("soLuongDat").alias("tongSoLuong"))
    )
    named = _join(star, sums, star["Dim_MatHang"].select("sk_matHang", "maMH", "tenMH"), "Dim_MatHang")
    return (
        named.orderBy(F.desc("tongTien"), "maMH")
        .limit(n)
        .select("maMH", "tenMH", "tongSoLuong", F.col("tongTien").cast("double").alias("tongTien"))
    )


def customer_types(star: Star) -> DataFrame:
    """Ordering customers and revenue per type. Once summed per customer, each
    customer is one row: counting them needs no distinct."""
    sums = star["Fact_DonDatHang"].groupBy("sk_khachHang").agg(_revenue().alias("tien"))
    typed = _join(
        star, sums, star["Dim_KhachHang"].select("sk_khachHang", "loaiKhachHang"), "Dim_KhachHang"
    )
    return (
        typed.groupBy("loaiKhachHang")
        .agg(F.count(F.lit(1)).alias("soKhachHang"), F.sum("tien").cast("double").alias("tongDoanhThu"))
        .orderBy(F.desc("tongDoanhThu"))
    )


def customer_types_stored(cells: DataFrame, cube: SetCube) -> DataFrame:
    """The same from the cells of a stored set cube; with sketches, estimated counts."""
    found = distinct_customers(cells, cube, ("loaiKhachHang",))
    return found.select("loaiKhachHang", "soKhachHang", "tongDoanhThu").orderBy(F.desc("tongDoanhThu"))


def stock_by_store(star: Star) -> DataFrame:
    rows = _join(star, _on_sale(star), _store_labels(star, "maCH", "tenThanhPho"), "Dim_CuaHang")
    rows = _join(star, rows, star["Dim_MatHang"].select("sk_matHang", "maMH", "tenMH"), "Dim_MatHang")
    return rows.select("maCH", "tenThanhPho", "maMH", "tenMH", "sk_thoiGian", "soLuongTonKho").orderBy(
        "maCH", F.desc("soLuongTonKho"), "maMH", "sk_thoiGian"
    )


def products_on_sale(star: Star) -> DataFrame:
    """Stores and the goods they sell, one row per stock record."""
    rows = _join(
        star,
        _on_sale(star).select("sk_cuaHang", "sk_matHang"),
        _store_labels(star, "tenThanhPho", "mien", "soDienThoai"),
        "Dim_CuaHang",
    )
    goods = star["Dim_MatHang"].select("sk_matHang", "moTa", "kichCo", "trongLuong", "gia")
    return _join(star, rows, goods, "Dim_MatHang").drop("sk_cuaHang", "sk_matHang")


def orders_per_customer(star: Star, distinct: bool = False) -> DataFrame:
    """Customer, order and day at line grain, or once per order."""
    rows = with_calendar(
        star, star["Fact_DonDatHang"].select("sk_khachHang", "sk_thoiGian", "maDon"), ("ngay",)
    )
    if distinct:
        rows = rows.distinct()
    names = star["Dim_KhachHang"].select("sk_khachHang", "tenKH")
    return _join(star, rows, names, "Dim_KhachHang").select("tenKH", "maDon", "ngay")


def stores_for_customer(star: Star, customer: object) -> DataFrame:
    """Stores that sell goods the customer has ordered."""
    who = star["Dim_KhachHang"].filter(F.col("maKH") == F.lit(customer)).select("sk_khachHang")
    ordered = star["Fact_DonDatHang"].join(F.broadcast(who), "sk_khachHang", "left_semi")  # one key
    # There are at most as many distinct goods as products, and stores as stores:
    # the dimensions' row counts bound what is broadcast.
    goods = ordered.select("sk_matHang").distinct()
    stock = _join(star, _on_sale(star), goods, "Dim_MatHang", "left_semi")
    stores = stock.select("sk_cuaHang").distinct()
    labels = _store_labels(star, "maCH", "tenThanhPho", "soDienThoai")
    return _join(star, labels, stores, "Dim_CuaHang", "left_semi").drop("sk_cuaHang")


def office_stock_above(star: Star, product: object, threshold: int) -> DataFrame:
    """Offices whose stores hold more than ``threshold`` of the product.

    Stock is summed over its daily records, as in the stock cubes.
    """
    per_store = _stock_of(star, product).groupBy("sk_cuaHang").agg(F.sum("soLuongTonKho").alias("ton"))
    placed = _join(
        star, per_store, star["Dim_CuaHang"].select("sk_cuaHang", "sk_diaDiem"), "Dim_CuaHang"
    )
    per_office = placed.groupBy("sk_diaDiem").agg(F.sum("ton").alias("tongTonKho"))
    offices = star["Dim_DiaDiem"].select("sk_diaDiem", "maTP", "diaChiVP", "tenThanhPho", "mien")
    return _join(
        star, per_office.filter(F.col("tongTonKho") > threshold), offices, "Dim_DiaDiem"
    ).select("maTP", "diaChiVP", "tenThanhPho", "mien", "tongTonKho")


def suppliers(star: Star) -> DataFrame:
    """Each (product, store) with stock, once. Joining stock records themselves
    to order lines would repeat every line per record."""
    return _on_sale(star).select("sk_matHang", "sk_cuaHang").distinct()


def order_sourcing(star: Star) -> DataFrame:
    """Order lines with every store that can supply them.

    The report is by nature lines x stores per product, so the rows are streamed
    out of the join and never gathered: the join's hot products are split over
    tasks by adaptive execution, and store labels are attached to the
    (product, store) side before it.
    """
    where = _join(star, suppliers(star), _store_labels(star, "maCH", "tenThanhPho"), "Dim_CuaHang")
    what = star["Dim_MatHang"].select("sk_matHang", "maMH", "moTa")
    offered = _join(star, where, what, "Dim_MatHang").drop("sk_cuaHang")
    lines = star["Fact_DonDatHang"].select("sk_matHang", "maDon")
    return lines.join(offered, "sk_matHang").select("maDon", "maMH", "moTa", "maCH", "tenThanhPho")


#: Rows of factorised sourcing: an order line, or a store of a product's supplier set.
LINE, SUPPLY = "dong", "cung"


def sourcing_sets(star: Star) -> DataFrame:
    """Order sourcing without its product: every order line once, naming its product's
    supplier set, and every set once, a row for each of its stores. The size is lines plus
    supply pairs, where the flat report has lines times stores."""
    goods = star["Dim_MatHang"].select("sk_matHang", "maMH", "moTa")
    lines = _join(star, star["Fact_DonDatHang"].select("sk_matHang", "maDon"), goods.drop("moTa"), "Dim_MatHang")
    where = _join(star, suppliers(star), _store_labels(star, "maCH", "tenThanhPho"), "Dim_CuaHang")
    sets = _join(star, where, goods, "Dim_MatHang")
    return lines.select(F.lit(LINE).alias("phan"), "maMH", "maDon").unionByName(
        sets.select(F.lit(SUPPLY).alias("phan"), "maMH", "moTa", "maCH", "tenThanhPho"), allowMissingColumns=True
    )


def unfolded(sets: DataFrame, order: object | None = None) -> DataFrame:
    """The flat report from factorised sourcing: of one order, or of all."""
    lines = sets.filter(F.col("phan") == LINE).select("maMH", "maDon")
    if order is not None:
        lines = lines.filter(F.col("maDon") == F.lit(order))
    stores = sets.filter(F.col("phan") == SUPPLY).select("maMH", "moTa", "maCH", "tenThanhPho")
    return lines.join(stores, "maMH").select("maDon", "maMH", "moTa", "maCH", "tenThanhPho")


def customer_place(star: Star, customer: object) -> DataFrame:
    return (
        customer_view(star)
        .filter(F.col("maKH") == F.lit(customer))
        .select("maKH", "tenKH", "tenThanhPho", "mien")
    )


def stock_in_city(star: Star, product: object, city: str) -> DataFrame:
    """Stock of one product in the stores of one city."""
    labels = store_view(star).filter(F.col("tenThanhPho") == F.lit(city)).select("sk_cuaHang", "maCH")
    goods = star["Dim_MatHang"].filter(F.col("maMH") == F.lit(product)).select("sk_matHang", "moTa")
    rows = _join(star, _stock_of(star, product), labels, "Dim_CuaHang")
    rows = _join(star, rows, goods, "Dim_MatHang")
    return rows.groupBy("maCH", "moTa").agg(F.sum("soLuongTonKho").alias("tongTonKho"))


def order_detail(star: Star, order: object) -> DataFrame:
    """One order: its goods, quantities, customer and possible stores."""
    lines = star["Fact_DonDatHang"].filter(F.col("maDon") == F.lit(order))
    names = star["Dim_KhachHang"].select("sk_khachHang", "maKH", "tenKH")
    lines = _join(star, lines, names, "Dim_KhachHang", "left")
    goods = star["Dim_MatHang"].select("sk_matHang", "maMH", "tenMH")
    lines = _join(star, lines, goods, "Dim_MatHang")
    stock = _join(star, _on_sale(star), lines.select("sk_matHang").distinct(), "Dim_MatHang", "left_semi")
    where = _join(
        star,
        stock.select("sk_cuaHang", "sk_matHang").distinct(),
        _store_labels(star, "maCH", "tenThanhPho"),
        "Dim_CuaHang",
    )
    return lines.join(where, "sk_matHang", "left").select(
        "maDon", "maMH", "tenMH", "soLuongDat", "maKH", "tenKH", "maCH", "tenThanhPho"
    )


def customer_groups(star: Star) -> DataFrame:
    """Customers who are travel only, postal only, or both, each group tagged."""
    groups = [
        star["Dim_KhachHang"]
        .filter(F.col("loaiKhachHang") == label)
        .select("maKH", "tenKH", F.lit(label).alias("loai"))
        for label in (TRAVEL, POSTAL, BOTH)
    ]
    return reduce(DataFrame.unionByName, groups)


# --- customer groups as set operations on the subtype tables -------------------


def _having(raw: dict[str, DataFrame], table: str, attribute: str) -> DataFrame:
    return raw[table].filter(F.col(attribute).isNotNull()).select(F.col("khachhangmakh").alias("maKH"))


def customers_both(raw: dict[str, DataFrame]) -> DataFrame:
    travel = _having(raw, "khachhang_dulich", "hdvdulich")
    return travel.intersect(_having(raw, "khachhang_buudien", "diachibuudien"))


def customers_travel_only(raw: dict[str, DataFrame]) -> DataFrame:
    travel = _having(raw, "khachhang_dulich", "hdvdulich")
    return travel.subtract(_having(raw, "khachhang_buudien", "diachibuudien"))


def customers_postal_only(raw: dict[str, DataFrame]) -> DataFrame:
    postal = _having(raw, "khachhang_buudien", "diachibuudien")
    return postal.subtract(_having(raw, "khachhang_dulich", "hdvdulich"))


# --- helpers -----------------------------------------------------------------


def _store_labels(star: Star, *columns: str) -> DataFrame:
    return store_view(star).select("sk_cuaHang", *columns)


def _stock_of(star: Star, product: object) -> DataFrame:
    """Stock rows of one product: its single surrogate key is a broadcast row."""
    which = star["Dim_MatHang"].filter(F.col("maMH") == F.lit(product)).select("sk_matHang")
    return star["Fact_TonKho"].join(F.broadcast(which), "sk_matHang", "left_semi")
