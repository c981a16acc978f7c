from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaarcube.functions.columns import (
    customer_type, date_key, day_name, key_date, key_day, key_month, key_year, lenient_date, line_revenue,
    lower_columns, nan_to_null, pick,
)
from tests.conftest import values


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2200, 1, 1)), min_size=1, max_size=20))
def test_date_key_and_its_inverse(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", date_key(F.col("d")).alias("k"))
    key = F.col("k")
    rows = df.select("d", "k", key_date(key), key_year(key), key_month(key), key_day(key)).collect()
    for d, k, back, year, month, dom in rows:
        assert k == int(d.strftime("%Y%m%d"))
        assert (back, year, month, dom) == (d, d.year, d.month, d.day)


def test_null_date_has_null_key(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert df.select(date_key(F.col("d"))).first()[0] is None


def test_lenient_date_and_day_name(spark):
    df = spark.createDataFrame([("2025-01-15",), ("2025-02-30",), ("gi do",), (None,)], "t string")
    day = lenient_date(F.col("t"))
    assert [tuple(r) for r in df.select(day, day_name(day)).collect()] == [
        (dt.date(2025, 1, 15), "Wednesday"), (None, None), (None, None), (None, None),
    ]


@pytest.mark.parametrize(
    "guide, address, expected",
    [
        ("g", "a", "Ca hai"), ("g", None, "Du lich"), (None, "a", "Buu dien"), (None, None, "Khong phan loai"),
    ],
)
def test_customer_type(spark, guide, address, expected):
    df = spark.createDataFrame([(guide, address)], "g string, a string")
    assert df.select(customer_type(F.col("g"), F.col("a"))).first()[0] == expected


def test_revenue_is_exact(spark):
    df = spark.createDataFrame([(3, 0.1)], "q int, p double")
    assert str(df.select(line_revenue(F.col("q"), F.col("p"))).first()[0]) == "0.30"


def test_lower_pick_and_nan(spark):
    df = spark.createDataFrame([(float("nan"), 1)], "Gia double, maMH int")
    assert lower_columns(df).columns == ["gia", "mamh"]
    assert pick(df, {"maMH": "ma", "Gia": "g"}).columns == ["ma", "g"]
    assert values(nan_to_null(df)) == [(None, 1)]
