from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaarcube.plans.cubes import CUBES, build_cube, specs_for
from bazaarcube.plans.star import build_star
from bazaarcube.session import folder_names, new_folder
from bazaarcube.streaming import stock_stream
from bazaarcube.streaming.cube_stream import read_cube
from bazaarcube.streaming.stock_stream import start_stock_stream, store_corrections, write_corrected_batch
from tests.conftest import source_frames, values

D = dt.date
SPECS = specs_for("inventory", (0, 1))
BATCHES = [
    [(5, D(2025, 1, 1), "M1", "S1"), (7, D(2025, 1, 1), "M2", "S1"), (3, D(2024, 5, 5), "M1", "S2"), (2, D(2025, 1, 1), "M1", "S1")],
    [(9, D(2025, 1, 1), "M1", "S1"), (6, D(2025, 1, 1), "M2", "S1"), (1, D(2025, 1, 2), "M1", "S1"), (4, D(2025, 1, 1), "M9", "S1")],
    [(4, D(2024, 5, 5), "M1", "S2"), (9, D(2025, 1, 1), "M1", "S1"), (8, D(2025, 1, 1), "M9", "S1"), (5, None, "M1", "S1")],
    [(6, None, "M1", "S1"), (0, D(2025, 1, 3), "M2", "S2")],
]


@pytest.fixture(scope="module")
def source(spark):
    everything = [r for b in BATCHES for r in b]
    return source_frames(
        spark, vanphongdaidien=[("T1", "Hue", None, "m", None), ("T2", "Da Nang", None, "m", None)],
        cuahang=[("S1", "0", None, "T1"), ("S2", "0", None, "T2")],
        mathang=[(m, m, None, None, None, None, None) for m in ("M1", "M2")], mathang_duoctru=everything,
    )


@pytest.fixture(scope="module")
def star(spark, source):
    return build_star(spark, source, new_folder(spark, "star"))


def batch(source, rows):
    df = source["mathang_duoctru"]
    return df.sparkSession.createDataFrame(rows, df.schema)


def check(star, path):
    for name in ("inv_cube_0d", "inv_cube_1d_thang", "inv_cube_1d_thanhpho", "inv_cube_1d_mathang"):
        assert values(read_cube(star, path, CUBES[name], SPECS)) == values(build_cube(star, CUBES[name])), name


def test_corrected_days_count_once(spark, star, source, monkeypatch):
    path, state = new_folder(spark, "sums"), new_folder(spark, "closes")
    write_corrected_batch(star, batch(source, BATCHES[0]), SPECS, path, state, 0)
    assert read_cube(star, path, CUBES["inv_cube_0d"], SPECS).first()[0] == 5 + 7 + 3
    write_corrected_batch(star, batch(source, BATCHES[1]), SPECS, path, state, 1)
    assert read_cube(star, path, CUBES["inv_cube_0d"], SPECS).first()[0] == 9 + 7 + 3 + 1 + 4
    # the closes of a batch are stored, then it fails before its sums are written
    store_corrections(spark, batch(source, BATCHES[2]), state, 2)
    for n in (1, 2, 2, 0):  # replays
        write_corrected_batch(star, batch(source, BATCHES[n]), SPECS, path, state, n)
    write_corrected_batch(star, batch(source, []), SPECS, path, state, 3)
    write_corrected_batch(star, batch(source, BATCHES[3]), SPECS, path, state, 4)
    check(star, path)
    assert len(folder_names(spark, state)) == 5


def test_a_batch_reads_only_its_years(spark, source):
    state = new_folder(spark, "closes")
    store_corrections(spark, batch(source, BATCHES[0]), state, 0)
    like = stock_stream.last_records(batch(source, BATCHES[1]))
    plan = stock_stream.earlier_closes(spark, state, 1, like, [2025])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(nam_ghi" in plan or "PartitionFilters: [isnotnull(nam_ghi" in plan


def test_records_with_a_time(spark):
    rows = [("M", "S", 5, dt.datetime(2025, 1, 1, 9)), ("M", "S", 3, dt.datetime(2025, 1, 1, 18)), ("M", "S", 4, dt.datetime(2025, 1, 1, 12))]
    df = spark.createDataFrame(rows, "mathangmamh string, cuahangmach string, soluongtrongkho int, thoigiannhap timestamp")
    state = new_folder(spark, "closes")
    one = store_corrections(spark, df.filter("soluongtrongkho = 5"), state, 0).first()
    two = store_corrections(spark, df.filter("soluongtrongkho = 3"), state, 1).first()
    assert (one.moi.soLuong, one.truoc, two.moi.soLuong, two.truoc.soLuong) == (5, None, 3, 5)
    assert store_corrections(spark, df.filter("soluongtrongkho = 4"), state, 2).count() == 0  # entered late, but earlier


def test_a_stream_of_records(spark, star, source):
    landing = new_folder(spark, "records")
    for rows in BATCHES:
        batch(source, rows).coalesce(1).write.mode("append").parquet(landing)
    records = spark.readStream.schema(source["mathang_duoctru"].schema).option("maxFilesPerTrigger", 1).parquet(landing)
    path = new_folder(spark, "sums")
    start_stock_stream(star, records, SPECS, path, new_folder(spark, "closes"), new_folder(spark, "progress"), available_now=True).awaitTermination()
    check(star, path)
