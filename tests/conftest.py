from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bazaarcube.plans.star import build_star  # noqa: E402
from bazaarcube.schemas import SOURCE_SCHEMAS, WAREHOUSE  # noqa: E402
from bazaarcube.session import build_session, new_folder, stage  # noqa: E402
from bazaarcube.sinks.warehouse import Star  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def source_frames(spark, **rows):
    """The nine operational tables; tables without rows are empty."""
    return {
        name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SOURCE_SCHEMAS.items()
    }


@pytest.fixture(scope="session")
def edge_raw(spark):
    """One small source with every awkward case."""
    money = Decimal
    return source_frames(
        spark,
        vanphongdaidien=[
            ("TP001", "Hue", "1 Le Loi", "Mien Trung", day("2020-01-01")),
            ("TP002", "Hue", "2 Le Loi", "Mien Trung", day("2020-01-01")),  # same city, another office
            ("TP003", "Ha Noi", "3 Hang Bai", "Mien Bac", None),
            ("TP004", "Ha Noi", "4 Cho Moi", "Mien Nam", None),  # same city name, another region
        ],
        cuahang=[
            ("CH001", "0901", day("2024-01-15"), "TP001"),
            ("CH002", "0902", day("2024-06-01"), "TP003"),
            ("CH003", "0903", None, "TP999"),  # unknown office
            ("CH004", "0904", None, "TP004"),
        ],
        mathang=[
            ("MH0001", "Ao", "ao so mi", "M", 0.5, 100.0, day("2024-02-01")),
            ("MH0002", "Quan", "quan dai", "L", float("nan"), 200.0, None),
            ("MH0003", "Ao", "ao khoac", "XL", None, 300.0, None),  # same name, another product
        ],
        khachhang=[
            ("KH00001", "An", day("2024-12-31"), "TP001"),  # travel only
            ("KH00002", "Binh", None, "TP002"),  # postal only
            ("KH00003", "Chi", None, "TP003"),  # both
            ("KH00004", "Dung", None, "TP004"),  # neither
            ("KH00005", "Em", None, None),  # no office; travel row without guide
            ("KH00006", "Giang", None, "TP999"),  # unknown office
        ],
        khachhang_dulich=[
            ("KH00001", "HDV A", day("2024-01-01")),
            ("KH00003", "HDV B", None),
            ("KH00005", None, None),
        ],
        khachhang_buudien=[("KH00002", "PO 2", None), ("KH00003", "PO 3", None)],
        dondathang=[
            ("DON001", day("2024-02-29"), "KH00001"),
            ("DON002", day("2024-12-31"), "KH00002"),
            ("DON003", day("2025-01-01"), "KH00003"),
            ("DON004", day("2025-02-28"), None),  # no customer
            ("DON005", None, "KH00004"),  # no date
            ("DON006", day("2025-02-01"), "KH00005"),
            ("DON007", day("2025-03-01"), "KH99999"),  # unknown customer
            ("DON008", day("2025-02-15"), "KH00006"),
        ],
        mathang_duocdat=[
            (10, money("0.10"), "MH0001", "DON001"),
            (5, money("0.20"), "MH0002", "DON001"),
            (3, money("19.99"), "MH0003", "DON002"),
            (0, money("5.00"), "MH0001", "DON003"),  # all measures zero
            (2, money("7.25"), "MH0002", "DON003"),
            (4, money("1.50"), "MH0001", "DON004"),
            (6, money("2.50"), "MH0001", "DON005"),
            (7, money("3.33"), "MH0003", "DON006"),
            (1, money("9.99"), "MH9999", "DON001"),  # unknown product
            (1, money("9.99"), "MH0001", "DON999"),  # unknown order
            (8, money("4.00"), "MH0002", "DON007"),
            (9, money("6.00"), "MH0002", "DON008"),
        ],
        mathang_duoctru=[
            (50, day("2025-01-15"), "MH0001", "CH001"),
            (70, day("2025-01-15"), "MH0001", "CH001"),  # same product, store and day
            (20, day("2025-01-16"), "MH0001", "CH001"),
            (0, day("2025-01-15"), "MH0002", "CH002"),
            (30, day("2025-01-15"), "MH0002", "CH003"),
            (40, day("2025-01-15"), "MH8888", "CH002"),  # unknown product
            (25, day("2025-02-01"), "MH0003", "CH002"),
            (15, day("2025-02-01"), "MH0003", "CH004"),
            (5, None, "MH0003", "CH002"),  # no date
        ],
    )


@pytest.fixture(scope="session")
def edge_star(spark, edge_raw) -> Star:
    return build_star(spark, edge_raw, new_folder(spark, "edge"))


@pytest.fixture(scope="session")
def golden_star(spark) -> Star:
    """The worked examples of the documentation as stored tables."""
    rows = {
        "Dim_ThoiGian": [
            (20250110, day("2025-01-10"), 1, 1, 2025),
            (20250115, day("2025-01-15"), 1, 1, 2025),
            (20250116, day("2025-01-16"), 1, 1, 2025),
        ],
        "Dim_DiaDiem": [(1, "TP001", "Mien Bac", None, None, "Ha Noi")],
        "Dim_MatHang": [(i, f"ten {i}", f"MH{i}", None, None, None, None, None) for i in (2, 3)],
        "Dim_KhachHang": [(i, 1, f"KH{i}", None, None, None, None, "Khong phan loai") for i in (5, 8)],
        "Dim_CuaHang": [(i, f"CH{i}", None, None, 1) for i in (1, 2)],
        "Fact_DonDatHang": [
            (5, 2, 20250115, "DH001", 10, Decimal(50000), Decimal(500000)),
            (5, 3, 20250115, "DH001", 5, Decimal(75000), Decimal(375000)),
            (8, 2, 20250116, "DH002", 20, Decimal(50000), Decimal(1000000)),
        ],
        "Fact_TonKho": [(20250115, 2, 1, 50), (20250115, 3, 1, 100), (20250110, 2, 2, 75)],
    }
    tables = {
        name: stage(spark.createDataFrame(data, WAREHOUSE[name].schema), name) for name, data in rows.items()
    }
    return Star(tables, {name: len(data) for name, data in rows.items()})


@pytest.fixture
def tiny_broadcast(spark):
    """Every dimension counts as too large to broadcast."""
    spark.conf.set("bazaarcube.broadcast.rows", "0")
    yield
    spark.conf.unset("bazaarcube.broadcast.rows")


def values(df, *columns):
    """Rows as a sorted list of tuples; NULL sorts first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
