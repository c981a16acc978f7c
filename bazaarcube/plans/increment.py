"""Adding a load to a stored star instead of building it anew.

Members keep the keys they have, so facts, stored cubes and files that wait for a
stream go on pointing to the same members. Order lines that are not stored yet are
appended: anti joins on (order, product), limited to the years of the arriving orders,
leave out what is stored, most of it before the lines meet their orders. Lines stored
before their customer was known get the key once it is, and the daily closes of stock
are replaced by later ones; both rewrite only the years they touch. A load is a new
version: its manifest names the new folders and those of earlier versions that still
count, and readers see it when the pointer moves.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.functions.columns import key_year
from bazaarcube.operators.dims import dim_cuahang, dim_diadiem, dim_khachhang, dim_mathang, dim_thoigian
from bazaarcube.operators.facts import LINE, fact_dondathang, fact_tonkho, keyed_days
from bazaarcube.operators.quality import require_unique
from bazaarcube.plans.star import build_star
from bazaarcube.schemas import UNIQUE_BEFORE_LOAD, WAREHOUSE
from bazaarcube.session import read_pointer, stage
from bazaarcube.sinks.runlog import now
from bazaarcube.sinks.warehouse import (
    POINTER,
    VERSIONS,
    YEAR,
    Part,
    Star,
    fact_rows,
    open_star,
    open_table,
    publish_version,
    read_manifest,
    stored_rows,
    write_manifest,
    write_table,
)
from bazaarcube.sources.operational import Tables

ORDERS, STOCK = "Fact_DonDatHang", "Fact_TonKho"


def years_of(rows: DataFrame) -> list[int | None]:
    """The years of fact rows, at most those of the calendar; None for rows without a day."""
    return sorted((r[0] for r in rows.select(key_year(F.col("sk_thoiGian"))).distinct().collect()), key=lambda y: (y is not None, y or 0))


def same_years(rows: DataFrame, years: list[int | None]) -> DataFrame:
    days = [y for y in years if y is not None]
    counts = F.col(YEAR).isin(days) if days else F.lit(False)
    return rows.filter(counts | F.col(YEAR).isNull() if None in years else counts)


def settled_lines(stored: DataFrame) -> DataFrame:
    """The lines that are stored with their customer only. Nothing that arrives changes
    them, so they are left out of a load before its lines meet their orders."""
    known, unknown = (stored.filter(f"sk_khachHang IS {what}").select(*LINE) for what in ("NOT NULL", "NULL"))
    return known.join(unknown, list(LINE), "left_anti")


def new_order_lines(arriving: DataFrame, unknown: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the arriving lines that are not settled those that are not stored, and the
    stored lines without a customer that arrive with one: the first replace the
    second. ``unknown``: the rows of the arriving years that are stored without a customer."""
    customers = arriving.filter("sk_khachHang IS NOT NULL").select(*LINE)
    late = stage(unknown.select(*WAREHOUSE[ORDERS].columns).join(customers, list(LINE), "left_semi"), "late-members")
    waiting = unknown.select(*LINE).join(late.select(*LINE), list(LINE), "left_anti")
    return arriving.join(waiting, list(LINE), "left_anti"), late


def merged_closes(arriving: DataFrame, stored: DataFrame) -> DataFrame:
    """Daily closes of the stored and arriving records of the same years. Days have no
    time, so the larger of two closes of a day counts, as within one load. Rows
    of unknown products or stores are kept, equal ones once."""
    columns = WAREHOUSE[STOCK].columns
    both = stored.select(*columns).unionByName(arriving.select(*columns))
    known = F.col("sk_matHang").isNotNull() & F.col("sk_cuaHang").isNotNull() & F.col("sk_thoiGian").isNotNull()
    closes = both.filter(known).groupBy("sk_thoiGian", "sk_matHang", "sk_cuaHang").agg(F.max("soLuongTonKho").alias("soLuongTonKho"))
    return closes.unionByName(both.filter(~known).distinct()).select(*columns)


def increment_star(spark: SparkSession, raw: Tables, warehouse: str) -> Star:
    """Add ``raw`` (all source rows, or new and changed ones) to the warehouse; the
    first load builds it."""
    require_unique(raw, UNIQUE_BEFORE_LOAD)
    version = f"{now():%Y%m%dT%H%M%S%f}"
    current = read_pointer(spark, f"{warehouse}/{POINTER}")
    if current is None:
        star = build_star(spark, raw, f"{warehouse}/{VERSIONS}/{version}")
        publish_version(spark, warehouse, version)
        return star
    old, parts = open_star(spark, warehouse), read_manifest(spark, warehouse, current)
    folder = f"{warehouse}/{VERSIONS}/{version}"

    def dimension(name: str, df: DataFrame) -> tuple[DataFrame, int]:
        write_table(df, name, folder)
        parts[name] = [Part(f"{VERSIONS}/{version}/{name}")]
        stored = open_table(spark, folder, name, df.schema)
        return stored, stored_rows(stored)

    def stored_in(name: str, years: list[int | None]) -> DataFrame:
        return same_years(fact_rows(spark, warehouse, parts[name]), years)

    def add(name: str, written: DataFrame, replaced: list[int | None]) -> None:
        """Store rows, and the years that they replace."""
        write_table(written, name, folder)
        if replaced:
            everything = years_of(fact_rows(spark, warehouse, parts[name]))
            rest = [p.only([y for y in everything if y not in replaced]) for p in parts[name]]
            parts[name] = [p for p in rest if p.years]
        parts[name] = [*parts[name], Part(f"{VERSIONS}/{version}/{name}")]

    def orders(customers: tuple[DataFrame, int], products: tuple[DataFrame, int]) -> None:
        years = years_of(keyed_days(raw))
        if not years:
            return
        stored = stored_in(ORDERS, years)
        arriving = stage(fact_dondathang(raw, *customers, *products, settled_lines(stored)), "arriving")
        new, late = new_order_lines(arriving, stored.filter("sk_khachHang IS NULL"))
        replaced = years_of(late)
        if replaced:
            kept = same_years(stored, replaced).select(*WAREHOUSE[ORDERS].columns)
            new = new.unionByName(kept.join(late.select(*LINE), list(LINE), "left_anti"))
        add(ORDERS, new, replaced)

    def stock(products: tuple[DataFrame, int], stores: tuple[DataFrame, int]) -> None:
        arriving = stage(fact_tonkho(raw, *products, *stores), "arriving")
        years = years_of(arriving)
        if years:
            add(STOCK, merged_closes(arriving, stored_in(STOCK, years)), years)

    # tables that do not depend on each other are sent to Spark together
    with ThreadPoolExecutor(3) as pool:
        calendar = pool.submit(lambda: dimension("Dim_ThoiGian", dim_thoigian(raw, old["Dim_ThoiGian"])))
        items = pool.submit(lambda: dimension("Dim_MatHang", dim_mathang(raw, old["Dim_MatHang"])))
        places = dimension("Dim_DiaDiem", dim_diadiem(raw, old["Dim_DiaDiem"]))
        buyers = pool.submit(lambda: dimension("Dim_KhachHang", dim_khachhang(raw, *places, old["Dim_KhachHang"])))
        shops = pool.submit(lambda: dimension("Dim_CuaHang", dim_cuahang(raw, *places, old["Dim_CuaHang"])))
        added = [
            pool.submit(lambda: orders(buyers.result(), items.result())),
            pool.submit(lambda: stock(items.result(), shops.result())),
        ]
        for done in (calendar, *added):
            done.result()
    write_manifest(spark, warehouse, version, parts)
    publish_version(spark, warehouse, version)
    return open_star(spark, warehouse)
