"""Surrogate keys of ids that are too many to broadcast."""

from __future__ import annotations

import pytest

from bazaarcube.operators.joins import join_key
from bazaarcube.session import new_folder
from bazaarcube.streaming.stock_stream import store_corrections


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def packing(spark):
    spark.conf.set("bazaarcube.broadcast.rows", "10")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("bazaarcube.broadcast.rows")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


IDS = {
    "packed": ("bigint", [-256, -1, 0, 1, 7, 255, 256, 300, 400, 600, 601, None]),
    "repeated": ("bigint", [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]),
    "far apart": ("bigint", [i * 1_000_003 for i in range(12)]),
    "text": ("string", [str(i) for i in range(12)]),
}


@pytest.mark.parametrize("kind", IDS)
def test_keys_are_packed_by_id(spark, packing, kind):
    """Rows are not shuffled to find integer ids; other ids are found as before."""
    of, ids = IDS[kind]
    dim = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], f"ma {of}, sk int")
    left = spark.createDataFrame([(i, n) for n, i in enumerate([*ids, *ids, None, ids[3]])], f"ma {of}, n int")
    left = left.union(spark.createDataFrame([("77", 99)], "ma string, n int").selectExpr(f"cast(ma as {of})", "n"))
    for how in ("inner", "left"):
        found = join_key(left, dim, "ma", how, len(ids))
        assert ("hashpartitioning(ma" in plan(found)) == (kind != "packed")
        assert sorted(found.select("ma", "n", "sk").collect(), key=str) == sorted(left.join(dim, "ma", how).select("ma", "n", "sk").collect(), key=str)


def test_new_and_stored_closes_meet_in_one_shuffle(spark, monkeypatch):
    import pyspark.sql.classic.dataframe as frames

    schema = "mathangmamh int, cuahangmach int, soluongtrongkho int, thoigiannhap date"
    rows = spark.createDataFrame([(1, 1, 5, None), (1, 2, 3, None), (None, 1, 4, None)], schema)
    state, plans = new_folder(spark, "closes"), []
    store_corrections(spark, rows, state, 0)
    usual = frames.DataFrame.write.fget
    monkeypatch.setattr(frames.DataFrame, "write", property(lambda df: plans.append(plan(df)) or usual(df)))
    more = spark.createDataFrame([(1, 1, 6, None), (1, 2, 2, None), (None, 1, 9, None), (2, 2, 1, None)], schema)
    found = store_corrections(spark, more, state, 1).select("maMH", "maCH", "moi.soLuong", "truoc.soLuong").collect()
    assert sorted(map(tuple, found), key=str) == [(1, 1, 6, 5), (2, 2, 1, None), (None, 1, 9, 4)]
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1]
