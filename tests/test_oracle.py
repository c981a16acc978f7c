"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registered
from bazaarcube import queries as warehouse
from oracles import queries as oracle
from tests.conftest import TESTDATA

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
# Grouping columns differ only by name here: one cube per join pattern is enough
# for a quick run; all of them are compared over the larger tables.
SAMPLED = {
    "cube_0d", "cube_1d_ma_kh", "cube_1d_thanhpho", "cube_2d_nam_bang", "cube_2d_ma_kh_ma_mh",
    "cube_3d_quy_ma_mh_thanhpho", "cube_3d_thang_loai_kh_ma_mh", "inv_cube_0d", "inv_cube_1d_thanhpho",
    "inv_cube_2d_thang_mathang", "inv_cube_2d_mathang_bang", "cube_2d_product_time",
    "inv_cube_3d_store_product_time", "cube_incremental_day", "cube_2d_product_time_stored",
    "inv_cube_3d_store_product_time_stored", "cube_resolved_day",
}
NAMES = sorted(
    name for name in warehouse.queries() if name in SAMPLED or not name.startswith(("cube_", "inv_cube_"))
)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    """Every query of the warehouse; what else is registered has tests of its own."""
    assert set(warehouse.queries()) == set(oracle.oracle_sql())
    assert set(warehouse.queries()) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    result = registered.queries()[name](spark, TESTDATA)
    columns = sorted(result.columns)
    relation = db.sql(registered.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in relation.fetchall())
    actual = sorted(repr(tuple(row)) for row in result.select(*columns).collect())
    assert actual == expected


def test_entry(spark):
    assert registered.entry(spark).count() == 35
