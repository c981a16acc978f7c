"""Roles and descriptions of columns for the data dictionaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The description of each known column.
DESCRIPTIONS: dict[str, str] = {
    "sk_thoiGian": "Khóa thay thế (Surrogate Key) Dimension Thời Gian",
    "sk_diaDiem": "Khóa thay thế (Surrogate Key) Dimension Địa Điểm",
    "sk_matHang": "Khóa thay thế (Surrogate Key) Dimension Mặt Hàng",
    "sk_khachHang": "Khóa thay thế (Surrogate Key) Dimension Khách Hàng",
    "sk_cuaHang": "Khóa thay thế (Surrogate Key) Dimension Cửa Hàng",
    "maMH": "Mã mặt hàng (Natural Key)",
    "tenMH": "Tên mặt hàng",
    "moTa": "Mô tả chi tiết mặt hàng",
    "kichCo": "Kích cỡ mặt hàng",
    "trongLuong": "Trọng lượng mặt hàng",
    "gia": "Giá bán niêm yết hiện tại",
    "ngayMoBan": "Ngày mặt hàng bắt đầu được phân phối",
    "maTP": "Mã Thành Phố/Văn Phòng Đại Diện (Natural Key)",
    "mien": "Miền / Bang khu vực",
    "tenThanhPho": "Tên thành phố của Cửa hàng/Văn phòng",
    "diaChiVP": "Địa chỉ văn phòng đại diện quản lý",
    "ngayThanhLapVP": "Ngày thành lập văn phòng",
    "maCH": "Mã chi nhánh Cửa Hàng (Natural Key)",
    "soDienThoai": "Số điện thoại cửa hàng",
    "maKH": "Mã Khách Hàng (Natural Key)",
    "tenKH": "Họ tên đầy đủ của khách hàng",
    "loaiKhachHang": "Phân khúc khách hàng (Du Lịch / Bưu Điện / Cả Hai)",
    "huongDanVien": "Tên hướng dẫn viên (Dành cho KH du lịch)",
    "diaChiBuuDien": "Địa chỉ hòm thư (Dành cho KH bưu điện)",
    "ngayDatHangDauTien": "Ngày khách hàng phát sinh đơn đầu tiên",
    "ngay": "Ngày",
    "thang": "Tháng",
    "quy": "Quý",
    "nam": "Năm",
    "soLuongDat": "Số lượng mặt hàng được đặt trong đơn",
    "giaDat": "Đơn giá của mặt hàng tại đúng thời điểm đặt hàng (có thể khác giá niêm yết)",
    "thanhTien": "Doanh thu của mặt hàng trong đơn (Số lượng × Giá đặt)",
    "soLuongTon": "Số lượng tồn kho được ghi nhận tại thời điểm snapshot",
    "tongDoanhThu": "Tổng doanh thu bán hàng sau khi quy đổi",
    "tongSoLuong": "Tổng số lượng hàng hóa được đặt",
    "soLanDat": "Tổng số lượt/đơn phát sinh",
    "soLuongTonKho": "Tổng mức quy mô tồn kho hiện tại được tổng hợp",
}
DEFAULT_DESCRIPTION = "Thuộc tính phân tích"

# The role labels.
DW_MEASURE = "Measure (Đo lường)"
DW_KEY = "Surrogate Key (Khóa nhân tạo)"
DW_ATTRIBUTE = "Dimension Attribute (Thuộc tính)"
CUBE_MEASURE = "Measure (Đo lường, Tổng/Đếm)"
CUBE_ATTRIBUTE = "Dimension Attribute (Chiều phân tích)"


def warehouse_role(name: Column) -> Column:
    measure = name.startswith("soLuong") | name.isin("gia", "thanhTien", "tongDoanhThu")
    return F.when(measure, DW_MEASURE).when(name.contains("sk_"), DW_KEY).otherwise(DW_ATTRIBUTE)


def cube_role(name: Column) -> Column:
    measure = name.startswith("tong") | name.startswith("soLan") | name.startswith("soLuong")
    return F.when(measure, CUBE_MEASURE).otherwise(CUBE_ATTRIBUTE)


def description(comment: Column, name: Column) -> Column:
    """The stored comment, else the known description, else the default."""
    known = F.create_map(*[F.lit(x) for pair in DESCRIPTIONS.items() for x in pair])
    written = F.when(F.trim(comment) != "", comment)
    return F.coalesce(written, F.try_element_at(known, name), F.lit(DEFAULT_DESCRIPTION))
