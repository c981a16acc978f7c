"""The two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarcube.functions.columns import date_key, line_revenue, pick
from bazaarcube.operators.joins import join_key
from bazaarcube.schemas import MONEY, WAREHOUSE
from bazaarcube.sources.operational import Tables


#: What names an order line in the fact.
LINE = ("maDon", "sk_matHang")


def keyed_days(raw: Tables) -> DataFrame:
    """The orders with their customer's id and the key of their day."""
    orders = pick(raw["dondathang"], {"madon": "maDon", "ngaydathang": "ngay", "khachhangmakh": "maKH"})
    return orders.select("maDon", "maKH", date_key(F.col("ngay")).alias("sk_thoiGian"))


def fact_dondathang(
    raw: Tables,
    customers: DataFrame,
    customer_rows: int,
    products: DataFrame,
    product_rows: int,
    settled: DataFrame | None = None,
) -> DataFrame:
    """Order lines with surrogate keys and exact revenue.

    The customer key is looked up on the orders, before they meet their lines:
    the lines, by far the larger table, are then shuffled once (by order).
    Lines of unknown orders or products drop out; an order without a known
    customer keeps its lines, with a NULL customer key. Lines named in ``settled``
    are left out before they meet their orders.
    """
    keyed_orders = join_key(
        keyed_days(raw), customers.select("sk_khachHang", "maKH"), "maKH", "left", customer_rows
    ).drop("maKH")
    lines = pick(
        raw["mathang_duocdat"],
        {"dondathangmadon": "maDon", "mathangmamh": "maMH", "soluongdat": "soLuongDat", "giadat": "giaDat"},
    ).withColumn("giaDat", F.col("giaDat").cast(MONEY))
    # The product dimension has exactly the known products, so one inner join
    # both drops unknown products and finds the surrogate key.
    keyed_lines = join_key(lines, products.select("sk_matHang", "maMH"), "maMH", "inner", product_rows)
    if settled is not None:
        keyed_lines = keyed_lines.join(settled, list(LINE), "left_anti")
    return (
        keyed_lines.join(keyed_orders, "maDon", "inner")
        .withColumn("thanhTien", line_revenue(F.col("soLuongDat"), F.col("giaDat")))
        .select(*WAREHOUSE["Fact_DonDatHang"].columns)
    )


def daily_close(stock: DataFrame) -> DataFrame:
    """The last stock figure per (maMH, maCH, day), as an aggregate that combines
    map-side, so a product and store with very many records costs no more.

    "Last" is by entry time, then by quantity. Within a day a DATE ties, which
    leaves the largest quantity: a plain maximum.
    """
    quantity = F.col("soLuongTonKho")
    if isinstance(stock.schema["thoiGianNhap"].dataType, T.DateType):
        close = F.max(quantity)
    else:
        close = F.max(F.struct("thoiGianNhap", "soLuongTonKho"))["soLuongTonKho"]
    return stock.groupBy("maMH", "maCH", date_key(F.to_date("thoiGianNhap")).alias("sk_thoiGian")).agg(
        close.alias("soLuongTonKho")
    )


def fact_tonkho(
    raw: Tables, products: DataFrame, product_rows: int, stores: DataFrame, store_rows: int
) -> DataFrame:
    closed = daily_close(
        pick(
            raw["mathang_duoctru"],
            {
                "mathangmamh": "maMH", "cuahangmach": "maCH",
                "soluongtrongkho": "soLuongTonKho", "thoigiannhap": "thoiGianNhap",
            },
        )
    )
    keyed = join_key(closed, products.select("sk_matHang", "maMH"), "maMH", "left", product_rows)
    keyed = join_key(keyed, stores.select("sk_cuaHang", "maCH"), "maCH", "left", store_rows)
    return keyed.select(*WAREHOUSE["Fact_TonKho"].columns)


def quarantine(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a missing surrogate key, with the reason. The fact keeps them
    as well: queries that use the missing axis lose exactly these rows."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(key).isNull(), F.lit(key)).otherwise(F.lit(None)) for key in keys])
    )
    return fact.filter(
        " OR ".join(f"{key} IS NULL" for key in keys)
    ).withColumn("lyDo", F.concat(F.lit("missing "), F.array_join(missing, ", ")))
