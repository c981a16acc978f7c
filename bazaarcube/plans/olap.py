"""Roll-up, drill-down, slice and dice, and the source reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.functions.columns import line_revenue
from bazaarcube.operators.joins import join_dim
from bazaarcube.plans.cubes import SUBJECTS, CubeSpec, build_cube, group_cell, with_calendar
from bazaarcube.plans.lattice import answer_from_cube, only_where
from bazaarcube.plans.star import store_view
from bazaarcube.sinks.warehouse import Star
from bazaarcube.sources.operational import Tables


def rollup_geo(star: Star) -> DataFrame:
    """Stock by region, city and store, with the subtotals of each level.

    The stock is summed per store first, so the roll-up expands one row per
    store. ``capDo`` tells a subtotal from a store without a place.
    """
    per_store = star["Fact_TonKho"].groupBy("sk_cuaHang").agg(F.sum("soLuongTonKho").alias("ton"))
    labels = store_view(star).filter("mien is not null").select("sk_cuaHang", "mien", "tenThanhPho", "maCH")
    placed = join_dim(per_store, labels, "sk_cuaHang", "inner", star.rows["Dim_CuaHang"])
    return placed.rollup("mien", "tenThanhPho", "maCH").agg(
        F.sum("ton").alias("tongTonKho"), F.grouping_id().cast("int").alias("capDo")
    )


def drill_down(star: Star, region: str) -> DataFrame:
    """From one region's revenue down to its cities by month."""
    spec = CubeSpec("drill", "order", ("mien", "tenThanhPho", "nam", "thang"), 2)
    return build_cube(star, spec).filter(F.col("mien") == F.lit(region))


def drill_to_stores(star: Star, city: str) -> DataFrame:
    """From one city's stock down to its stores by month."""
    spec = CubeSpec("drill", "inventory", ("tenThanhPho", "maCH", "nam", "thang"), 3)
    return build_cube(star, spec).filter(F.col("tenThanhPho") == F.lit(city))


def slice_cube(star: Star, customer_type: str) -> DataFrame:
    """One customer type, by month."""
    spec = CubeSpec("slice", "order", ("nam", "thang", "loaiKhachHang"), 2)
    return build_cube(star, spec).filter(F.col("loaiKhachHang") == F.lit(customer_type))


def only_members(star: Star, subject: str, key: str, label: str, value: object) -> Star:
    """The star with the facts of one member of a dimension: its id is looked up
    first, so that only its rows are grouped."""
    what = SUBJECTS[subject]
    table, _ = what.labels[key]
    keys = star[table].filter(F.col(label) == F.lit(value)).select(key)
    rows = join_dim(star[what.fact], keys, key, "left_semi", star.rows[table])
    return Star({**star.tables, what.fact: rows}, star.rows)


def slice_customer(star: Star, customer: object) -> DataFrame:
    """One customer's purchases, by month."""
    one = only_members(star, "order", "sk_khachHang", "maKH", customer)
    return build_cube(one, CubeSpec("slice", "order", ("nam", "thang", "maKH"), 2))


def slice_product(star: Star, product: object) -> DataFrame:
    """One product's sales, by month."""
    one = only_members(star, "order", "sk_matHang", "maMH", product)
    return build_cube(one, CubeSpec("slice", "order", ("nam", "thang", "maMH"), 2))


def slice_city(star: Star, city: str) -> DataFrame:
    """One city's sales, by month."""
    spec = CubeSpec("slice", "order", ("nam", "thang", "tenThanhPho"), 2)
    return build_cube(star, spec).filter(F.col("tenThanhPho") == F.lit(city))


def dice_cube(star: Star, product: object, city: str, month: int) -> DataFrame:
    """One product in one city in one calendar month, by year and type."""
    one = only_members(star, "order", "sk_matHang", "maMH", product)
    group = ("nam", "thang", "maMH", "tenThanhPho", "loaiKhachHang")
    return build_cube(one, CubeSpec("dice", "order", group, 4)).filter(
        (F.col("tenThanhPho") == F.lit(city)) & (F.col("thang") == month)
    )


def answer(
    star: Star, path: str, subject: str, group: Sequence[str], where: Mapping[str, object], rows: dict[str, int]
) -> tuple[str | None, DataFrame]:
    """A slice, dice, roll-up or drill-down: the grouping ``group`` with the values
    ``where``, from the smallest stored cube under ``path`` that can tell (its name comes
    with the answer), otherwise from the fact. ``rows`` counts the stored cubes."""
    try:
        return answer_from_cube(star.spark, path, subject, group, rows, where=where)
    except LookupError:
        asked = tuple(dict.fromkeys((*group, *where)))
        exact = CubeSpec("asked", subject, asked, len(asked))
        fact = star[SUBJECTS[subject].fact]
        fact = with_calendar(star, fact, exact.time) if exact.time else fact
        cells = only_where(group_cell(star, fact, exact, merged=False), where)
        measures = SUBJECTS[subject].measures
        summed = cells.groupBy(*group).agg(*[m.merged_sum() for m in measures])
        return None, summed.select(*group, *[m.report() for m in measures])


def latest_stock(star: Star) -> DataFrame:
    """Each product's newest stock figure per store, over all its records.

    Stock is not additive over time: summing the daily records, as the stock
    cubes do, counts the same goods once per record. This is the other reading.
    The newest figure is the largest (day, quantity) pair. Both fit in one number
    of 64 bits (the day above, the quantity moved to start at zero below), which
    keeps the aggregate in hash aggregation.
    """
    lowest = -(1 << 31)
    packed = F.shiftleft(F.col("sk_thoiGian").cast("bigint"), 32) + (F.col("soLuongTonKho").cast("bigint") - lowest)
    newest = (
        star["Fact_TonKho"]
        .filter(F.col("sk_thoiGian").isNotNull())
        .groupBy("sk_cuaHang", "sk_matHang")
        .agg(F.max(packed).alias("moi"))
    )
    return newest.select(
        "sk_cuaHang",
        "sk_matHang",
        F.shiftright("moi", 32).cast("int").alias("sk_thoiGian"),
        (F.col("moi").bitwiseAND(F.lit((1 << 32) - 1)) + lowest).cast("int").alias("soLuongTonKho"),
    )


def revenue_reconciliation(raw: Tables, star: Star) -> DataFrame:
    """Revenue per region computed from the source and from the warehouse."""
    lines = raw["mathang_duocdat"].select(
        F.col("dondathangmadon").alias("madon"), line_revenue(F.col("soluongdat"), F.col("giadat")).alias("tien")
    )
    orders = raw["dondathang"].select("madon", F.col("khachhangmakh").alias("makh"))
    customers = raw["khachhang"].select("makh", F.col("vanphongdaidienmatp").alias("matp"))
    # Summed per customer before the customer and office tables are joined.
    per_customer = (
        lines.join(orders, "madon").groupBy("makh").agg(F.sum("tien").cast("decimal(38,2)").alias("tien"))
    )
    source = (
        per_customer.join(customers, "makh")
        .join(raw["vanphongdaidien"].select("matp", "mien"), "matp")
        .groupBy("mien")
        .agg(F.sum("tien").cast("double").alias("doanhThuNguon"))
    )
    stored = build_cube(star, CubeSpec("recon", "order", ("mien",), 1)).select(
        "mien", F.col("tongDoanhThu").alias("doanhThuKho")
    )
    both = source.join(stored, "mien", "full_outer")
    return both.withColumn("khop", F.col("doanhThuNguon").eqNullSafe(F.col("doanhThuKho")))
