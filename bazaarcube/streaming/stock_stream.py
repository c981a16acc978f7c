"""Stock cubes that follow corrected records.

Stock cubes sum daily closes: of the records of a product in a store on a day only the
last counts. A stream that adds every record would count a corrected day twice. Here the
closes made so far are kept by (product, store, day), one folder for each batch, and a
batch adds to the cubes what its closes differ by from those. Records of a day may
thus come in any number of batches, and late.

Replays: a batch reads only the closes of earlier batches and stores its own, with what
they replace, under its number before its sums are written. A batch that is repeated finds
its folder and takes the same differences again; sums written already are left alone.
The closes are stored by year, and a batch reads only the years it has records of.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarcube.functions.columns import date_key, key_year, pick
from bazaarcube.operators.joins import join_key
from bazaarcube.plans.cubes import CubeSpec
from bazaarcube.schemas import WAREHOUSE
from bazaarcube.session import exists, folder_names, move_folder, remove_folder
from bazaarcube.sinks.warehouse import YEAR, Star
from bazaarcube.streaming.cube_stream import committed_batch, write_batch

_KEY = ("maMH", "maCH", "sk_thoiGian")


def _entries(records: DataFrame) -> DataFrame:
    """Product, store, day and entry (``moi``: time and quantity) of records in the shape of the source."""
    named = pick(records, {"mathangmamh": "maMH", "cuahangmach": "maCH", "soluongtrongkho": "soLuong", "thoigiannhap": "luc"})
    return named.select("maMH", "maCH", date_key(F.to_date("luc")).alias("sk_thoiGian"), F.struct("luc", "soLuong").alias("moi"))


def last_records(records: DataFrame) -> DataFrame:
    """The last record (``moi``: entry time and quantity) per product, store and day of
    ``records`` in the shape of the source; of equal times the largest quantity."""
    return _entries(records).groupBy(*_KEY).agg(F.max("moi").alias("moi"))


def batch_numbers(spark: SparkSession, state: str) -> list[int]:
    return sorted(int(n.removeprefix("lo=")) for n in folder_names(spark, state) if n.startswith("lo="))


def stored_closes(spark: SparkSession, state: str, batch_id: int, like: DataFrame, years: list[int | None]) -> DataFrame:
    """The closes of ``years`` that the batches before ``batch_id`` stored; the largest counts."""
    schema = like.withColumn("truoc", F.col("moi")).withColumn(YEAR, F.lit(0)).schema
    days = [y for y in years if y is not None]
    parts = [spark.createDataFrame([], schema)]
    for n in batch_numbers(spark, state):
        if n < batch_id:
            rows = spark.read.schema(schema).parquet(f"{state}/lo={n}")
            parts.append(rows.filter(F.col(YEAR).isin(days) | F.col(YEAR).isNull() if None in years else F.col(YEAR).isin(days)))
    return reduce(DataFrame.unionByName, parts)


def earlier_closes(spark: SparkSession, state: str, batch_id: int, like: DataFrame, years: list[int | None]) -> DataFrame:
    """The closes of ``years`` as the batches before ``batch_id`` left them."""
    return stored_closes(spark, state, batch_id, like, years).groupBy(*_KEY).agg(F.max("moi").alias("truoc"))


def store_corrections(spark: SparkSession, records: DataFrame, state: str, batch_id: int) -> DataFrame:
    """The closes that the batch makes or changes, with what they replace (``truoc``),
    stored under the batch's number unless they are there already."""
    final = f"{state}/lo={batch_id}"
    entries = _entries(records)
    if not exists(spark, final):
        years = [r[0] for r in entries.select(key_year(F.col("sk_thoiGian"))).distinct().collect()]
        before = stored_closes(spark, state, batch_id, entries, years)
        # new entries and stored closes meet in one grouping, so each is shuffled once
        both = entries.withColumn("truoc", F.lit(None).cast(entries.schema["moi"].dataType)).unionByName(
            before.select(*_KEY, F.lit(None).cast(entries.schema["moi"].dataType).alias("moi"), F.col("moi").alias("truoc"))
        )
        met = both.groupBy(*_KEY).agg(F.max("moi").alias("moi"), F.max("truoc").alias("truoc"))
        changed = met.filter(F.col("moi").isNotNull() & (F.col("truoc").isNull() | (F.col("moi") > F.col("truoc"))))
        draft = f"{state}/_draft-{uuid.uuid4().hex}"
        changed.withColumn(YEAR, key_year(F.col("sk_thoiGian"))).write.partitionBy(YEAR).parquet(draft)
        if not move_folder(spark, draft, final):
            remove_folder(spark, draft)
    schema = entries.withColumn("truoc", F.col("moi")).withColumn(YEAR, F.lit(0)).schema
    return spark.read.schema(schema).parquet(final)


def differences(star: Star, changed: DataFrame) -> DataFrame:
    """Stock fact rows that turn the sums made so far into those of the new closes."""
    more = F.col("moi.soLuong") - F.coalesce("truoc.soLuong", F.lit(0))
    rows = changed.select(*_KEY, more.alias("soLuongTonKho"))
    rows = join_key(rows, star["Dim_MatHang"].select("sk_matHang", "maMH"), "maMH", "left", star.rows["Dim_MatHang"])
    rows = join_key(rows, star["Dim_CuaHang"].select("sk_cuaHang", "maCH"), "maCH", "left", star.rows["Dim_CuaHang"])
    return rows.select(*WAREHOUSE["Fact_TonKho"].columns)


def write_corrected_batch(star: Star, records: DataFrame, specs: Sequence[CubeSpec], path: str, state: str, batch_id: int) -> None:
    """One micro-batch of stock records into the sums at ``path``, with the closes kept
    at ``state``."""
    if batch_id <= committed_batch(star.spark, path):
        return
    write_batch(star, differences(star, store_corrections(star.spark, records, state, batch_id)), specs, path, batch_id)


def start_stock_stream(
    star: Star, records: DataFrame, specs: Sequence[CubeSpec], path: str, state: str, checkpoint: str, available_now: bool = False, every: str = "1 minute"
) -> StreamingQuery:
    """Keep the stock cubes ``specs`` up to date with a stream of source records."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_corrected_batch(star, batch, specs, path, state, batch_id)

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()
