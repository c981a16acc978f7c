"""The TPC-H-like tables presented in the nine operational shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.schemas import MONEY
from bazaarcube.sources.operational import Tables


def sources_from_testdata(spark: SparkSession, path: str) -> Tables:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")

    no_date = F.lit(None).cast("date")
    customer, lineitem, orders = read("customer"), read("lineitem"), read("orders")

    offices = (
        read("nation")
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("matp"),
            F.col("n_name").alias("tenthanhpho"),
            F.lit(None).cast("string").alias("diachivp"),
            F.col("r_name").alias("mien"),
            no_date.alias("ngaythanhlapvp"),
        )
    )
    stores = read("supplier").select(
        F.col("s_suppkey").alias("mach"),
        F.col("s_name").alias("sodienthoai"),
        no_date.alias("ngaythanhlapch"),
        F.col("s_nationkey").alias("vanphongdaidienmatp"),
    )
    products = read("part").select(
        F.col("p_partkey").alias("mamh"),
        F.col("p_name").alias("tenmh"),
        F.col("p_brand").alias("mota"),
        F.col("p_size").cast("string").alias("kichco"),
        F.lit(None).cast("double").alias("trongluong"),
        F.col("p_retailprice").alias("gia"),
        no_date.alias("ngaycapnhat"),
    )
    first_orders = orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("ngaydatdautien"))
    customers = customer.join(first_orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("makh"),
        F.col("c_name").alias("tenkh"),
        "ngaydatdautien",
        F.col("c_nationkey").alias("vanphongdaidienmatp"),
    )
    # Subtype membership is not stored in the customer table. It is assigned
    # from the key, so that all four customer types occur; every customer stays
    # in `khachhang` whatever its type.
    travel = customer.filter(F.col("c_custkey") % 10 < 3).select(
        F.col("c_custkey").alias("khachhangmakh"),
        F.concat(F.lit("HDL"), F.col("c_custkey") % 50).alias("hdvdulich"),
        no_date.alias("ngaydangky"),
    )
    postal = customer.filter(F.col("c_custkey") % 4 == 0).select(
        F.col("c_custkey").alias("khachhangmakh"),
        F.concat(F.lit("PO"), F.col("c_custkey") % 100).alias("diachibuudien"),
        no_date.alias("ngaydangky"),
    )
    return {
        "vanphongdaidien": offices,
        "cuahang": stores,
        "mathang": products,
        "mathang_duoctru": lineitem.select(
            F.col("l_quantity").cast("int").alias("soluongtrongkho"),
            F.to_date("l_shipdate").alias("thoigiannhap"),
            F.col("l_partkey").alias("mathangmamh"),
            F.col("l_suppkey").alias("cuahangmach"),
        ),
        "khachhang": customers,
        "khachhang_dulich": travel,
        "khachhang_buudien": postal,
        "dondathang": orders.select(
            F.col("o_orderkey").alias("madon"),
            F.to_date("o_orderdate").alias("ngaydathang"),
            F.col("o_custkey").alias("khachhangmakh"),
        ),
        "mathang_duocdat": lineitem.select(
            F.col("l_quantity").cast("int").alias("soluongdat"),
            F.col("l_extendedprice").cast(MONEY).alias("giadat"),
            F.col("l_partkey").alias("mathangmamh"),
            F.col("l_orderkey").alias("dondathangmadon"),
        ),
    }
