"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from bazaarcube.operators.facts import fact_dondathang
from bazaarcube.plans import reports
from bazaarcube.plans.cubes import CUBES, build_cube
from bazaarcube.plans.star import star_for_testdata
from bazaarcube.queries import queries
from bazaarcube.sources.testdata import sources_from_testdata
from tests.conftest import TESTDATA


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return star_for_testdata(spark, TESTDATA)


def test_cube_reads_only_its_columns(star):
    plan = build_cube(star, CUBES["cube_1d_nam"])._jdf.queryExecution().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any(s.startswith("sk_thoiGian:int,soLuongDat:int,thanhTien:decimal(18,2)") for s in schemas)
    assert not any("maDon" in s for s in schemas)


@pytest.mark.parametrize("cube", ["cube_1d_nam", "cube_2d_ma_kh_ma_mh", "cube_3d_quy_ma_mh_thanhpho"])
def test_small_dimensions_leave_one_shuffle(star, cube):
    plan = physical(build_cube(star, CUBES[cube]))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


@pytest.mark.parametrize(
    "name",
    ["cube_3d_quy_ma_mh_thanhpho", "fact_dondathang", "report_09_order_sourcing", "report_12_order_detail",
     "recon_revenue_by_state", "dq_orphans", "rollup_geo", "scd2_customer"],
)
def test_no_cross_joins_or_python(spark, name):
    plan = physical(queries()[name](spark, TESTDATA))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan, word


def test_filter_on_one_order_reaches_the_scan(star):
    plan = star["Fact_DonDatHang"].filter("maDon = 5")._jdf.queryExecution().toString()
    assert "EqualTo(maDon,5)" in plan


def test_top_products_sorts_only_the_top(star):
    assert "TakeOrderedAndProject" in physical(reports.top_products(star))


def test_hot_order_is_split(spark, star):
    """A third of all lines in one order: adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    raw = sources_from_testdata(spark, TESTDATA)
    lines = raw["mathang_duocdat"].repartition(8).withColumn(
        "dondathangmadon",
        F.when(F.col("mathangmamh") % 3 == 0, F.lit(5)).otherwise(F.col("dondathangmadon")).cast("bigint"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        fact = fact_dondathang(
            {**raw, "mathang_duocdat": lines}, star["Dim_KhachHang"], 150, star["Dim_MatHang"], 200
        )
        assert len(fact.collect()) == 6000
        assert "skew=true" in physical(fact)
    finally:
        for key in settings:
            spark.conf.unset(key)
