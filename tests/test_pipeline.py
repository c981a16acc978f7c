from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarcube.plans import pipeline
from bazaarcube.plans.pipeline import run_etl
from bazaarcube.session import new_folder, shared_dir
from bazaarcube.sinks.runlog import read_runs
from bazaarcube.sinks.warehouse import current_version, open_star
from bazaarcube.sources.operational import JdbcSplit, SourceConfig, load_sources
from tests.conftest import source_frames, values


def test_run_twice_equals_run_once(spark, edge_raw):
    path, cubes = new_folder(spark, "dw"), new_folder(spark, "cubes")
    first = run_etl(spark, edge_raw, path, cubes)
    assert first.exit_code == 0 and first.error is None
    before = values(spark.read.parquet(f"{cubes}/cube_2d_nam_bang"))
    second = run_etl(spark, edge_raw, path, cubes)
    assert second.loaded == first.loaded == open_star(spark, path).rows
    assert values(spark.read.parquet(f"{cubes}/cube_2d_nam_bang")) == before
    runs = read_runs(spark, f"{path}/pipeline_runs").collect()
    assert len(runs) == 2 and {r["status"] for r in runs} == {"SUCCESS"}
    assert runs[0]["records_extracted"] == sum(first.extracted.values())
    assert runs[0]["records_loaded"] == sum(first.loaded.values())
    version = current_version(spark, path)
    assert spark.read.parquet(f"{version}/quarantine/Fact_DonDatHang").count() == 3
    assert spark.read.parquet(f"{version}/quarantine/Fact_TonKho").count() == 2


def test_a_failed_refresh_leaves_the_old_star(spark, edge_raw):
    path = new_folder(spark, "dw")
    assert run_etl(spark, edge_raw, path).exit_code == 0
    before = {name: values(open_star(spark, path)[name]) for name in ("Dim_KhachHang", "Fact_DonDatHang")}
    customers = edge_raw["khachhang"].union(spark.createDataFrame([("KH00000", "New", None, None)], edge_raw["khachhang"].schema))
    broken = edge_raw["mathang_duocdat"].withColumn("soluongdat", F.raise_error(F.lit("broken line")).cast("int"))
    result = run_etl(spark, {**edge_raw, "khachhang": customers, "mathang_duocdat": broken}, path)
    assert result.exit_code == 1
    assert {name: values(open_star(spark, path)[name]) for name in before} == before


@pytest.mark.parametrize("step", ["write_quarantine", "build_cubes"])
def test_nothing_is_published_before_all_is_stored(spark, edge_raw, monkeypatch, step):
    def fails(*args):
        raise OSError("no room")

    path = new_folder(spark, "dw")
    assert run_etl(spark, edge_raw, path).exit_code == 0
    before = current_version(spark, path)
    monkeypatch.setattr(pipeline, step, fails)
    result = run_etl(spark, edge_raw, path, new_folder(spark, "cubes"))
    assert result.exit_code == 1 and "no room" in result.error
    assert current_version(spark, path) == before


def test_failure_is_logged(spark):
    raw = source_frames(spark, mathang=[("M", "x", None, None, None, None, None)] * 2)
    path = new_folder(spark, "dw")
    result = run_etl(spark, raw, path)
    assert result.exit_code == 1 and "mathang" in result.error
    row = read_runs(spark, f"{path}/pipeline_runs").first()
    assert (row["status"], row["records_loaded"]) == ("FAILED", 0) and "mathang" in row["error_message"]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_sources_from_files(spark, edge_raw, fmt):
    folder = new_folder(spark, fmt)
    for name, df in edge_raw.items():
        df.write.format(fmt).save(f"{folder}/{name}")
    again = load_sources(spark, SourceConfig(fmt, folder))
    for name in ("dondathang", "mathang_duocdat", "khachhang_dulich"):
        assert values(again[name]) == values(edge_raw[name]), name
    assert again["mathang_duocdat"].first()["giadat"].__class__ is Decimal


def test_jdbc_options():
    conf = SourceConfig(
        "jdbc", "jdbc:postgresql://db/x", options={"user": "u"},
        splits={"dondathang": JdbcSplit("ngaydathang", "2025-01-01", "2026-01-01", 12)},
    )
    assert conf.reader_options("cuahang") == {
        "url": "jdbc:postgresql://db/x", "dbtable": "idb.cuahang", "user": "u"
    }
    assert conf.reader_options("dondathang")["numPartitions"] == "12"


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")
