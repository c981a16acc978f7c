"""Fixed table layouts: names, columns, keys and sort orders.

The values below are fixed: they are the table and column names that results
must carry.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(18,2)": MONEY,
}


def struct_of(columns: str) -> T.StructType:
    """``"a int, b date"`` as a schema, without needing a session."""
    pairs = [part.split(maxsplit=1) for part in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- operational tables (lower-case, as they arrive from the source) ---------

SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "vanphongdaidien": struct_of(
        "matp string, tenthanhpho string, diachivp string, mien string, ngaythanhlapvp date"
    ),
    "cuahang": struct_of(
        "mach string, sodienthoai string, ngaythanhlapch date, vanphongdaidienmatp string"
    ),
    "mathang": struct_of(
        "mamh string, tenmh string, mota string, kichco string, trongluong double, gia double, ngaycapnhat date"
    ),
    "mathang_duoctru": struct_of(
        "soluongtrongkho int, thoigiannhap date, mathangmamh string, cuahangmach string"
    ),
    "khachhang": struct_of(
        "makh string, tenkh string, ngaydatdautien date, vanphongdaidienmatp string"
    ),
    "khachhang_dulich": struct_of("khachhangmakh string, hdvdulich string, ngaydangky date"),
    "khachhang_buudien": struct_of("khachhangmakh string, diachibuudien string, ngaydangky date"),
    "dondathang": struct_of("madon string, ngaydathang date, khachhangmakh string"),
    "mathang_duocdat": struct_of(
        "soluongdat int, giadat decimal(18,2), mathangmamh string, dondathangmadon string"
    ),
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "vanphongdaidien": ("matp",),
    "cuahang": ("mach",),
    "mathang": ("mamh",),
    "mathang_duoctru": ("mathangmamh", "cuahangmach"),
    "khachhang": ("makh",),
    "khachhang_dulich": ("khachhangmakh",),
    "khachhang_buudien": ("khachhangmakh",),
    "dondathang": ("madon",),
    "mathang_duocdat": ("mathangmamh", "dondathangmadon"),
}

#: (child table, child column, parent table, parent column)
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("cuahang", "vanphongdaidienmatp", "vanphongdaidien", "matp"),
    ("mathang_duoctru", "mathangmamh", "mathang", "mamh"),
    ("mathang_duoctru", "cuahangmach", "cuahang", "mach"),
    ("khachhang", "vanphongdaidienmatp", "vanphongdaidien", "matp"),
    ("khachhang_dulich", "khachhangmakh", "khachhang", "makh"),
    ("khachhang_buudien", "khachhangmakh", "khachhang", "makh"),
    ("dondathang", "khachhangmakh", "khachhang", "makh"),
    ("mathang_duocdat", "mathangmamh", "mathang", "mamh"),
    ("mathang_duocdat", "dondathangmadon", "dondathang", "madon"),
)

# --- warehouse tables --------------------------------------------------------


@dataclass(frozen=True)
class TableLayout:
    """Column order, declared types and physical sort key of a warehouse table."""

    schema: T.StructType
    sort_key: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.names


WAREHOUSE: dict[str, TableLayout] = {
    "Dim_ThoiGian": TableLayout(
        struct_of("sk_thoiGian int, ngay date, thang int, quy int, nam int"),
        ("sk_thoiGian",),
    ),
    "Dim_MatHang": TableLayout(
        struct_of(
            "sk_matHang int, tenMH string, maMH string, moTa string, kichCo string, "
            "trongLuong double, gia double, ngayMoBan date"
        ),
        ("sk_matHang",),
    ),
    "Dim_DiaDiem": TableLayout(
        struct_of(
            "sk_diaDiem int, maTP string, mien string, diaChiVP string, ngayThanhLapVP date, tenThanhPho string"
        ),
        ("sk_diaDiem",),
    ),
    "Dim_CuaHang": TableLayout(
        struct_of(
            "sk_cuaHang int, maCH string, soDienThoai string, ngayThanhLapCH date, sk_diaDiem int"
        ),
        ("sk_cuaHang",),
    ),
    "Dim_KhachHang": TableLayout(
        struct_of(
            "sk_khachHang int, sk_diaDiem int, maKH string, tenKH string, ngayDatHangDauTien date, "
            "huongDanVien string, diaChiBuuDien string, loaiKhachHang string"
        ),
        ("sk_khachHang",),
    ),
    "Fact_DonDatHang": TableLayout(
        struct_of(
            "sk_khachHang int, sk_matHang int, sk_thoiGian int, maDon string, "
            "soLuongDat int, giaDat decimal(18,2), thanhTien decimal(18,2)"
        ),
        ("sk_thoiGian", "sk_khachHang", "maDon"),
    ),
    "Fact_TonKho": TableLayout(
        struct_of("sk_thoiGian int, sk_matHang int, sk_cuaHang int, soLuongTonKho int"),
        ("sk_thoiGian", "sk_cuaHang", "sk_matHang"),
    ),
}

#: Dimensions come before the facts that point to them.
LOAD_ORDER: tuple[str, ...] = (
    "Dim_ThoiGian",
    "Dim_DiaDiem",
    "Dim_MatHang",
    "Dim_KhachHang",
    "Dim_CuaHang",
    "Fact_DonDatHang",
    "Fact_TonKho",
)

#: Surrogate keys of each fact and the dimension each one points to.
FACT_KEYS: dict[str, dict[str, str]] = {
    "Fact_DonDatHang": {
        "sk_thoiGian": "Dim_ThoiGian",
        "sk_khachHang": "Dim_KhachHang",
        "sk_matHang": "Dim_MatHang",
    },
    "Fact_TonKho": {
        "sk_thoiGian": "Dim_ThoiGian",
        "sk_matHang": "Dim_MatHang",
        "sk_cuaHang": "Dim_CuaHang",
    },
}

#: Tables whose repeated keys would multiply customers, stores or products.
UNIQUE_BEFORE_LOAD = (
    "vanphongdaidien", "cuahang", "mathang", "khachhang", "khachhang_dulich", "khachhang_buudien",
)

RUN_LOG_SCHEMA = struct_of(
    "run_id string, job_name string, start_time timestamp, end_time timestamp, status string, "
    "records_extracted bigint, records_loaded bigint, error_message string"
)
