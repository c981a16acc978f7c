from __future__ import annotations

import pytest

from bazaarcube.operators.quality import (
    difference, foreign_key_report, insert_if_absent, key_violations, primary_key_report, require_unique,
)
from tests.conftest import source_frames, values


def test_keys_of_a_clean_source(edge_raw):
    report = {r["bang"]: r["so_khoa_loi"] for r in primary_key_report(edge_raw).collect()}
    # The stock table holds several records per product and store.
    assert report.pop("mathang_duoctru") == 2
    assert set(report.values()) == {0}


def test_repeated_subtype_row_is_caught(spark):
    raw = source_frames(
        spark, khachhang=[("K1", "x", None, None)], khachhang_dulich=[("K1", "a", None), ("K1", "b", None)]
    )
    assert values(key_violations(raw["khachhang_dulich"], ("khachhangmakh",))) == [("K1", 2)]
    with pytest.raises(ValueError, match="khachhang_dulich"):
        require_unique(raw, ["khachhang", "khachhang_dulich"])


def test_null_key_is_a_violation(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert values(key_violations(df, ("k",))) == [(None, 1)]


def test_orphans(edge_raw):
    broken = {
        (r["bang"], r["cot"]): (r["so_khoa_loi"], r["so_dong_loi"])
        for r in foreign_key_report(edge_raw).collect() if r["so_khoa_loi"]
    }
    assert broken == {
        ("cuahang", "vanphongdaidienmatp"): (1, 1),
        ("khachhang", "vanphongdaidienmatp"): (1, 1),
        ("dondathang", "khachhangmakh"): (1, 1),
        ("mathang_duoctru", "mathangmamh"): (1, 1),
        ("mathang_duocdat", "mathangmamh"): (1, 1),
        ("mathang_duocdat", "dondathangmadon"): (1, 1),
    }


def test_difference_counts_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert values(difference(a, b)) == [(1, "trai"), (3, "phai")]
    assert difference(a, a).isEmpty()


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 5), ("b", 4)], "k string, v int")
    once = insert_if_absent(old, new, ["k"])
    assert values(once) == [("a", 1), ("b", 4)]
    assert values(insert_if_absent(once, new, ["k"])) == values(once)
    assert values(insert_if_absent(old.select("k"), new.select("k"), ["k"])) == [("a",), ("b",)]
