from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarcube.plans import increment
from bazaarcube.plans.increment import increment_star
from bazaarcube.plans.star import build_star
from bazaarcube.session import folder_names, new_folder, read_pointer
from bazaarcube.sinks.warehouse import POINTER, VERSIONS, Part, fact_rows, open_star, publish_version, read_manifest
from tests.conftest import source_frames, values

D = dt.date


def load(spark, products, customers, lines, stock=(), offices=("T1",)):
    """lines: (order, day, customer, product, quantity); stock: (quantity, day, product, store)"""
    orders = {(o, d, c) for o, d, c, _, _ in lines}
    return source_frames(
        spark,
        vanphongdaidien=[(t, "city", None, "region", None) for t in offices],
        cuahang=[("S1", "0", None, "T1"), ("S2", "0", None, "T1")],
        mathang=[(p, f"name {p}", None, None, None, None, None) for p in products],
        khachhang=[(c, f"name {c}", None, "T1") for c in customers],
        dondathang=sorted(orders),
        mathang_duocdat=[(q, Decimal("2.50"), p, o) for o, _, _, p, q in lines],
        mathang_duoctru=list(stock),
    )


def keys(star, table, member, key):
    return {r[0]: r[1] for r in star[table].select(member, key).collect()}


FIRST = [("O1", D(2024, 1, 5), "C2", "P2", 1), ("O2", D(2024, 7, 1), "C9", "P4", 2), ("O3", D(2025, 2, 1), "C4", "P2", 3)]
THEN = [*FIRST, ("O4", D(2024, 3, 1), "C1", "P3", 4), ("O5", D(2026, 1, 1), "C9", "P1", 5)]
STOCK = [(5, D(2024, 1, 1), "P2", "S1"), (7, D(2025, 1, 1), "P4", "S2")]


@pytest.fixture(scope="module")
def grown(spark):
    """Two loads; the second knows members before, between and after those of the first,
    one of them the customer of an order that is stored without one."""
    path = new_folder(spark, "dw")
    first = increment_star(spark, load(spark, ["P2", "P4"], ["C2", "C4"], FIRST, STOCK), path)
    before = {t: (keys(first, t, m, k)) for t, m, k in (("Dim_MatHang", "maMH", "sk_matHang"), ("Dim_KhachHang", "maKH", "sk_khachHang"))}
    lines = values(first["Fact_DonDatHang"].filter("sk_khachHang IS NULL"))
    later = [(9, D(2024, 1, 1), "P2", "S1"), (4, D(2025, 1, 1), "P4", "S2"), (1, D(2025, 6, 1), "P3", "S2")]
    second = increment_star(spark, load(spark, ["P1", "P2", "P3", "P4", "P5"], ["C1", "C2", "C3", "C9"], THEN, later, ("T0", "T1")), path)
    return path, before, lines, second


def test_known_members_keep_their_keys(grown):
    _, before, _, star = grown
    assert before["Dim_MatHang"] == {"P2": 1, "P4": 2}
    assert keys(star, "Dim_MatHang", "maMH", "sk_matHang") == {"P2": 1, "P4": 2, "P1": 3, "P3": 4, "P5": 5}
    # a member that the source no longer has stays: facts point to it
    assert keys(star, "Dim_KhachHang", "maKH", "sk_khachHang") == {"C2": 1, "C4": 2, "C1": 3, "C3": 4, "C9": 5}
    assert keys(star, "Dim_DiaDiem", "maTP", "sk_diaDiem") == {"T1": 1, "T0": 2}


def test_only_new_lines_are_added_and_late_customers_get_their_key(grown):
    path, _, unknown, star = grown
    assert len(unknown) == 1 and "O2" in str(unknown)
    found = {(r.maDon, r.sk_khachHang, r.sk_matHang, r.soLuongDat) for r in star["Fact_DonDatHang"].collect()}
    assert found == {("O1", 1, 1, 1), ("O2", 5, 2, 2), ("O3", 2, 1, 3), ("O4", 3, 4, 4), ("O5", 5, 3, 5)}
    assert star.rows["Fact_DonDatHang"] == 5


def test_stock_closes_are_merged(grown):
    star = grown[3]
    found = {(r.sk_thoiGian, r.sk_matHang, r.sk_cuaHang, r.soLuongTonKho) for r in star["Fact_TonKho"].collect()}
    assert found == {(20240101, 1, 1, 9), (20250101, 2, 2, 7), (20250601, 4, 2, 1)}


def test_years_that_do_not_arrive_are_left_alone(spark, grown):
    path = grown[0]
    parts = read_manifest(spark, path, read_pointer(spark, f"{path}/{POINTER}"))
    first, second = parts["Fact_DonDatHang"]
    assert first.years == (2025,) and second.years is None  # 2024 was rewritten for the late customer
    plan = fact_rows(spark, path, [first]).filter(F.col("nam_ghi") == 2025)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(nam_ghi" in plan


def test_the_calendar_covers_all_loads(grown):
    row = grown[3]["Dim_ThoiGian"].agg(F.min("ngay"), F.max("ngay"), F.count("*")).first()
    assert (row[0], row[1]) == (D(2024, 1, 1), D(2026, 1, 1)) and row[2] == 732


def test_the_same_load_again_adds_nothing(spark, grown):
    path, star = grown[0], grown[3]
    before = {t: values(df) for t, df in star.tables.items()}
    again = increment_star(spark, load(spark, ["P2", "P4"], ["C2", "C4"], FIRST, STOCK), path)
    assert {t: values(df) for t, df in again.tables.items()} == before
    once_more = increment_star(spark, load(spark, [], [], []), path)
    assert {t: values(df) for t, df in once_more.tables.items()} == before


def test_a_failed_load_leaves_the_star_as_it_was(spark, grown, monkeypatch):
    path = grown[0]
    before = read_pointer(spark, f"{path}/{POINTER}")
    monkeypatch.setattr(increment, "fact_tonkho", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        increment_star(spark, load(spark, ["P7"], ["C7"], []), path)
    assert read_pointer(spark, f"{path}/{POINTER}") == before
    assert "P7" not in keys(open_star(spark, path), "Dim_MatHang", "maMH", "sk_matHang")


def test_folders_in_use_outlive_their_version(spark):
    path = new_folder(spark, "dw")
    for n in range(3):
        increment_star(spark, load(spark, ["P1"], ["C1"], [(f"O{n}", D(2024, 1, 1 + n), "C1", "P1", 1)]), path)
    assert open_star(spark, path).rows["Fact_DonDatHang"] == 3
    assert len(folder_names(spark, f"{path}/{VERSIONS}")) == 3
    build_star(spark, load(spark, ["P1"], ["C1"], FIRST), f"{path}/{VERSIONS}/zz1")
    build_star(spark, load(spark, ["P1"], ["C1"], FIRST), f"{path}/{VERSIONS}/zz2")
    publish_version(spark, path, "zz2")
    assert folder_names(spark, f"{path}/{VERSIONS}") in (["zz1", "zz2"], ["zz2", "zz1"])


def test_parts_keep_the_years_that_count():
    whole = Part("versions/a/Fact_TonKho")
    assert whole.only([None, 2024]).years == (None, 2024)
    assert whole.only([2024, 2025]).only([2025, 2026]).years == (2025,)


def test_settled_lines_are_left_out_before_they_meet_their_orders(spark, monkeypatch):
    path = new_folder(spark, "dw")
    increment_star(spark, load(spark, ["P2", "P4"], ["C2", "C4"], [*FIRST, FIRST[0]], STOCK), path)
    real, staged = increment.stage, []

    def seen(df, name):
        staged.append((name, real(df, name)))
        return staged[-1][1]

    monkeypatch.setattr(increment, "stage", seen)
    star = increment_star(spark, load(spark, ["P1", "P2", "P3", "P4"], ["C1", "C2", "C4", "C9"], [*THEN, FIRST[0], THEN[3]], STOCK), path)
    rows = {name: sorted(r.maDon for r in df.collect()) for name, df in staged if "maDon" in df.columns}
    # O1 (twice) and O3 are stored with their customers; O2 waits for its customer
    assert rows == {"arriving": ["O2", "O4", "O4", "O5"], "late-members": ["O2"]}
    found = sorted((r.maDon, r.sk_khachHang is None) for r in star["Fact_DonDatHang"].collect())
    assert found == [(o, False) for o in ("O1", "O1", "O2", "O3", "O4", "O4", "O5")]


def test_a_line_stored_with_and_without_its_customer_is_replaced(spark):
    path = new_folder(spark, "dw")
    twice = [("O1", D(2024, 1, 5), "C2", "P2", 1), ("O1", D(2024, 1, 5), "C9", "P2", 1)]  # one order under two customers
    sold = load(spark, ["P2"], ["C2"], twice)
    increment_star(spark, sold, path)
    before = values(open_star(spark, path)["Fact_DonDatHang"])
    assert values(increment_star(spark, sold, path)["Fact_DonDatHang"]) == before
    star = increment_star(spark, load(spark, ["P2"], ["C2", "C9"], twice), path)
    assert sorted(r.sk_khachHang for r in star["Fact_DonDatHang"].collect()) == [1, 1, 2, 2]
