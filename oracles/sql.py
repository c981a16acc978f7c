"""DuckDB SQL over the raw tables, written independently of the Spark plans.

Each statement starts from the same source shapes (as CTEs) and states the
warehouse tables and the results in plain SQL.
"""

from __future__ import annotations

SOURCES = """
vanphongdaidien AS (
  SELECT n_nationkey AS matp, n_name AS tenthanhpho, CAST(NULL AS VARCHAR) AS diachivp,
         r_name AS mien, CAST(NULL AS DATE) AS ngaythanhlapvp
  FROM nation JOIN region ON n_regionkey = r_regionkey),
cuahang AS (
  SELECT s_suppkey AS mach, s_name AS sodienthoai, CAST(NULL AS DATE) AS ngaythanhlapch,
         s_nationkey AS vanphongdaidienmatp FROM supplier),
mathang AS (
  SELECT p_partkey AS mamh, p_name AS tenmh, p_brand AS mota, CAST(p_size AS VARCHAR) AS kichco,
         CAST(NULL AS DOUBLE) AS trongluong, p_retailprice AS gia, CAST(NULL AS DATE) AS ngaycapnhat
  FROM part),
khachhang AS (
  SELECT c_custkey AS makh, c_name AS tenkh,
         (SELECT CAST(MIN(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) AS ngaydatdautien,
         c_nationkey AS vanphongdaidienmatp FROM customer),
khachhang_dulich AS (
  SELECT c_custkey AS khachhangmakh, 'HDL' || CAST(c_custkey % 50 AS VARCHAR) AS hdvdulich,
         CAST(NULL AS DATE) AS ngaydangky FROM customer WHERE c_custkey % 10 < 3),
khachhang_buudien AS (
  SELECT c_custkey AS khachhangmakh, 'PO' || CAST(c_custkey % 100 AS VARCHAR) AS diachibuudien,
         CAST(NULL AS DATE) AS ngaydangky FROM customer WHERE c_custkey % 4 = 0),
dondathang AS (
  SELECT o_orderkey AS madon, CAST(o_orderdate AS DATE) AS ngaydathang, o_custkey AS khachhangmakh
  FROM orders),
mathang_duocdat AS (
  SELECT CAST(l_quantity AS INTEGER) AS soluongdat, CAST(l_extendedprice AS DECIMAL(18,2)) AS giadat,
         l_partkey AS mathangmamh, l_orderkey AS dondathangmadon FROM lineitem),
mathang_duoctru AS (
  SELECT CAST(l_quantity AS INTEGER) AS soluongtrongkho, CAST(l_shipdate AS DATE) AS thoigiannhap,
         l_partkey AS mathangmamh, l_suppkey AS cuahangmach FROM lineitem)
"""

STAR = """
dim_diadiem AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY matp) AS INTEGER) AS "sk_diaDiem", matp AS "maTP", mien,
         diachivp AS "diaChiVP", ngaythanhlapvp AS "ngayThanhLapVP", tenthanhpho AS "tenThanhPho"
  FROM vanphongdaidien),
dim_mathang AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY mamh) AS INTEGER) AS "sk_matHang", tenmh AS "tenMH", mamh AS "maMH",
         mota AS "moTa", kichco AS "kichCo", trongluong AS "trongLuong", gia, ngaycapnhat AS "ngayMoBan"
  FROM mathang),
dim_khachhang AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY k.makh) AS INTEGER) AS "sk_khachHang", l."sk_diaDiem",
         k.makh AS "maKH", k.tenkh AS "tenKH", k.ngaydatdautien AS "ngayDatHangDauTien",
         d.hdvdulich AS "huongDanVien", b.diachibuudien AS "diaChiBuuDien",
         CASE WHEN d.hdvdulich IS NOT NULL AND b.diachibuudien IS NOT NULL THEN 'Ca hai'
              WHEN d.hdvdulich IS NOT NULL THEN 'Du lich'
              WHEN b.diachibuudien IS NOT NULL THEN 'Buu dien'
              ELSE 'Khong phan loai' END AS "loaiKhachHang"
  FROM khachhang k
  LEFT JOIN khachhang_dulich d ON d.khachhangmakh = k.makh
  LEFT JOIN khachhang_buudien b ON b.khachhangmakh = k.makh
  LEFT JOIN dim_diadiem l ON l."maTP" = k.vanphongdaidienmatp),
dim_cuahang AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY mach) AS INTEGER) AS "sk_cuaHang", mach AS "maCH",
         sodienthoai AS "soDienThoai", ngaythanhlapch AS "ngayThanhLapCH", l."sk_diaDiem"
  FROM cuahang LEFT JOIN dim_diadiem l ON l."maTP" = vanphongdaidienmatp),
moc AS (
  SELECT ngaydathang AS d FROM dondathang JOIN khachhang ON makh = khachhangmakh
  UNION ALL SELECT ngaycapnhat FROM mathang
  UNION ALL SELECT ngaythanhlapch FROM cuahang
  UNION ALL SELECT thoigiannhap FROM mathang_duoctru),
dim_thoigian AS (
  SELECT CAST(STRFTIME(ngay, '%Y%m%d') AS INTEGER) AS "sk_thoiGian", ngay,
         CAST(MONTH(ngay) AS INTEGER) AS thang, CAST(QUARTER(ngay) AS INTEGER) AS quy,
         CAST(YEAR(ngay) AS INTEGER) AS nam
  FROM (SELECT CAST(UNNEST(GENERATE_SERIES((SELECT MIN(d) FROM moc), (SELECT MAX(d) FROM moc), INTERVAL 1 DAY)) AS DATE) AS ngay)),
fact_dondathang AS (
  SELECT k."sk_khachHang", m."sk_matHang", CAST(STRFTIME(o.ngaydathang, '%Y%m%d') AS INTEGER) AS "sk_thoiGian",
         o.madon AS "maDon", l.soluongdat AS "soLuongDat", l.giadat AS "giaDat",
         CAST(l.soluongdat AS DECIMAL(10,0)) * l.giadat AS "thanhTien"
  FROM mathang_duocdat l
  JOIN mathang p ON p.mamh = l.mathangmamh
  JOIN dondathang o ON o.madon = l.dondathangmadon
  LEFT JOIN dim_khachhang k ON k."maKH" = o.khachhangmakh
  LEFT JOIN dim_mathang m ON m."maMH" = l.mathangmamh),
chot AS (
  SELECT CAST(l_partkey AS BIGINT) AS mamh, l_suppkey AS mach, CAST(l_shipdate AS DATE) AS ngay,
         CAST(l_quantity AS INTEGER) AS ton,
         ROW_NUMBER() OVER (
           PARTITION BY l_partkey, l_suppkey, CAST(l_shipdate AS DATE)
           ORDER BY l_shipdate DESC, l_quantity DESC, l_orderkey DESC, l_linenumber DESC,
                    l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS thu_tu
  FROM lineitem),
fact_tonkho AS (
  SELECT CAST(STRFTIME(c.ngay, '%Y%m%d') AS INTEGER) AS "sk_thoiGian", m."sk_matHang", s."sk_cuaHang",
         c.ton AS "soLuongTonKho"
  FROM chot c
  LEFT JOIN dim_mathang m ON m."maMH" = c.mamh
  LEFT JOIN dim_cuahang s ON s."maCH" = c.mach
  WHERE c.thu_tu = 1)
"""


def source_sql(select: str) -> str:
    return f"WITH {SOURCES}\n{select}"


def star_sql(select: str, more: str = "") -> str:
    return f"WITH {SOURCES},\n{STAR}{more}\n{select}"


# --- cubes ---------------------------------------------------------------------

# The FROM clause of each needed axis, by subject.
_FROM = {
    "order": {
        "fact": "fact_dondathang f",
        "T": 'JOIN dim_thoigian t ON t."sk_thoiGian" = f."sk_thoiGian"',
        "C": 'JOIN dim_khachhang c ON c."sk_khachHang" = f."sk_khachHang"',
        "L": 'JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"',
        "P": 'JOIN dim_mathang p ON p."sk_matHang" = f."sk_matHang"',
    },
    "inventory": {
        "fact": "fact_tonkho f",
        "T": 'JOIN dim_thoigian t ON t."sk_thoiGian" = f."sk_thoiGian"',
        "C": 'JOIN dim_cuahang c ON c."sk_cuaHang" = f."sk_cuaHang"',
        "L": 'JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"',
        "P": 'JOIN dim_mathang p ON p."sk_matHang" = f."sk_matHang"',
    },
}
_AXIS = {
    "nam": "T", "quy": "T", "thang": "T", "ngay": "T",
    "maKH": "C", "loaiKhachHang": "C", "maCH": "C",
    "maMH": "P", "tenMH": "P",
    "mien": "L", "tenThanhPho": "L",
}
_ALIAS = {"T": "t", "C": "c", "P": "p", "L": "l"}
REVENUE = 'CAST(SUM(f."thanhTien") AS DOUBLE) AS "tongDoanhThu"'
QUANTITY = 'CAST(SUM(f."soLuongDat") AS BIGINT) AS "tongSoLuong"'
LINES = 'CAST(COUNT(*) AS BIGINT) AS "soLanDat"'
STOCK = 'CAST(SUM(f."soLuongTonKho") AS BIGINT) AS "tongTonKho"'


def _column(name: str) -> str:
    return f'{_ALIAS[_AXIS[name]]}."{name}"'


def _joins(subject: str, axes: set[str]) -> str:
    wanted = axes | ({"C"} if "L" in axes else set())
    clauses = _FROM[subject]
    return "\n".join([f"FROM {clauses['fact']}", *[clauses[a] for a in "TCLP" if a in wanted]])


def cube_sql(subject: str, group: list[str], count: bool = False, where: str = "") -> str:
    sums = [REVENUE, QUANTITY] + ([LINES] if count else []) if subject == "order" else [STOCK]
    columns = [_column(g) for g in group]
    select = f"SELECT {', '.join(columns + sums)}\n{_joins(subject, {_AXIS[g] for g in group})}\n{where}"
    return star_sql(select + (f"\nGROUP BY {', '.join(columns)}" if columns else ""))


# The cube list of the documentation, written out: name -> grouping columns.
ORDER_CUBES: dict[str, str] = {
    "cube_0d": "",
    "cube_1d_nam": "nam",
    "cube_1d_quy": "nam quy",
    "cube_1d_thang": "nam thang",
    "cube_1d_loai_kh": "loaiKhachHang",
    "cube_1d_ma_kh": "maKH loaiKhachHang",
    "cube_1d_ma_mh": "maMH",
    "cube_1d_bang": "mien",
    "cube_1d_thanhpho": "mien tenThanhPho",
    "cube_2d_nam_loai_kh": "nam loaiKhachHang",
    "cube_2d_nam_ma_kh": "nam maKH loaiKhachHang",
    "cube_2d_quy_loai_kh": "nam quy loaiKhachHang",
    "cube_2d_quy_ma_kh": "nam quy maKH",
    "cube_2d_thang_loai_kh": "nam thang loaiKhachHang",
    "cube_2d_thang_ma_kh": "nam thang maKH",
    "cube_2d_nam_ma_mh": "nam maMH tenMH",
    "cube_2d_quy_ma_mh": "nam quy maMH tenMH",
    "cube_2d_thang_ma_mh": "nam thang maMH tenMH",
    "cube_2d_nam_bang": "nam mien",
    "cube_2d_nam_thanhpho": "nam mien tenThanhPho",
    "cube_2d_quy_bang": "nam quy mien",
    "cube_2d_quy_thanhpho": "nam quy mien tenThanhPho",
    "cube_2d_thang_bang": "nam thang mien",
    "cube_2d_thang_thanhpho": "nam thang mien tenThanhPho",
    "cube_2d_loai_kh_ma_mh": "loaiKhachHang maMH tenMH",
    "cube_2d_ma_kh_ma_mh": "maKH maMH tenMH",
    "cube_2d_loai_kh_bang": "loaiKhachHang mien",
    "cube_2d_loai_kh_thanhpho": "loaiKhachHang mien tenThanhPho",
    "cube_2d_ma_kh_thanhpho": "maKH mien tenThanhPho",
    "cube_2d_ma_kh_bang": "maKH mien",
    "cube_2d_ma_mh_bang": "maMH tenMH mien",
    "cube_2d_ma_mh_thanhpho": "maMH tenMH mien tenThanhPho",
    "cube_3d_nam_loai_kh_ma_mh": "nam loaiKhachHang maMH tenMH",
    "cube_3d_thang_loai_kh_ma_mh": "nam thang loaiKhachHang maMH tenMH",
    "cube_3d_quy_loai_kh_ma_mh": "nam quy loaiKhachHang maMH tenMH",
    "cube_3d_nam_ma_kh_ma_mh": "nam maKH maMH tenMH",
    "cube_3d_thang_ma_kh_ma_mh": "nam thang maKH maMH tenMH",
    "cube_3d_quy_ma_kh_ma_mh": "nam quy maKH maMH tenMH",
    "cube_3d_nam_loai_kh_bang": "nam loaiKhachHang mien",
    "cube_3d_thang_loai_kh_bang": "nam thang loaiKhachHang mien",
    "cube_3d_quy_loai_kh_bang": "nam quy loaiKhachHang mien",
    "cube_3d_nam_ma_kh_bang": "nam maKH mien",
    "cube_3d_thang_ma_kh_bang": "nam thang maKH mien",
    "cube_3d_quy_ma_kh_bang": "nam quy maKH mien",
    "cube_3d_nam_ma_kh_thanhpho": "nam maKH mien tenThanhPho",
    "cube_3d_thang_ma_kh_thanhpho": "nam thang maKH mien tenThanhPho",
    "cube_3d_quy_ma_kh_thanhpho": "nam quy maKH mien tenThanhPho",
    "cube_3d_nam_loai_kh_thanhpho": "nam loaiKhachHang mien tenThanhPho",
    "cube_3d_thang_loai_kh_thanhpho": "nam thang loaiKhachHang mien tenThanhPho",
    "cube_3d_quy_loai_kh_thanhpho": "nam quy loaiKhachHang mien tenThanhPho",
    "cube_3d_nam_ma_mh_bang": "nam maMH tenMH mien",
    "cube_3d_thang_ma_mh_bang": "nam thang maMH tenMH mien",
    "cube_3d_quy_ma_mh_bang": "nam quy maMH tenMH mien",
    "cube_3d_nam_ma_mh_thanhpho": "nam maMH tenMH mien tenThanhPho",
    "cube_3d_thang_ma_mh_thanhpho": "nam thang maMH tenMH mien tenThanhPho",
    "cube_3d_quy_ma_mh_thanhpho": "nam quy maMH tenMH mien tenThanhPho",
    "cube_3d_loai_kh_ma_mh_bang": "loaiKhachHang maMH tenMH mien",
    "cube_3d_loai_kh_ma_mh_thanhpho": "loaiKhachHang maMH tenMH mien tenThanhPho",
    "cube_3d_ma_kh_ma_mh_bang": "maKH maMH tenMH mien",
    "cube_3d_ma_kh_ma_mh_thanhpho": "maKH maMH tenMH mien tenThanhPho",
}
INVENTORY_CUBES: dict[str, str] = {
    "inv_cube_0d": "",
    "inv_cube_1d_nam": "nam",
    "inv_cube_1d_quy": "nam quy",
    "inv_cube_1d_thang": "nam thang",
    "inv_cube_1d_mathang": "maMH",
    "inv_cube_1d_bang": "mien",
    "inv_cube_1d_thanhpho": "tenThanhPho",
    "inv_cube_2d_nam_mathang": "nam maMH",
    "inv_cube_2d_quy_mathang": "nam quy maMH",
    "inv_cube_2d_thang_mathang": "nam thang maMH",
    "inv_cube_2d_nam_bang": "nam mien",
    "inv_cube_2d_nam_thanhpho": "nam tenThanhPho",
    "inv_cube_2d_quy_bang": "nam quy mien",
    "inv_cube_2d_quy_thanhpho": "nam quy tenThanhPho",
    "inv_cube_2d_thang_bang": "nam thang mien",
    "inv_cube_2d_thang_thanhpho": "nam thang tenThanhPho",
    "inv_cube_2d_mathang_bang": "maMH mien",
    "inv_cube_2d_mathang_thanhpho": "maMH tenThanhPho",
}
GUIDE_CUBES: dict[str, tuple[str, str]] = {
    "cube_1d_product": ("order", "maMH"),
    "cube_1d_time": ("order", "ngay"),
    "cube_2d_product_time": ("order", "maMH ngay"),
    "inv_cube_1d_store": ("inventory", "maCH"),
    "inv_cube_2d_store_product": ("inventory", "maCH maMH"),
    "inv_cube_2d_store_time": ("inventory", "maCH ngay"),
    "inv_cube_3d_store_product_time": ("inventory", "maCH maMH ngay"),
}


def lattice_sql(subject: str, cubes: dict[str, str]) -> str:
    """All cubes at once: GROUPING SETS with one bit of ``gid`` per column."""
    order = ["nam", "quy", "thang", "maKH", "loaiKhachHang", "maMH", "tenMH", "mien", "tenThanhPho"]
    used = [c for c in order if any(c in g.split() for g in cubes.values())]
    columns = [_column(c) for c in used]
    sets = ", ".join("(" + ", ".join(_column(c) for c in g.split()) + ")" for g in cubes.values())
    sums = [REVENUE, QUANTITY] if subject == "order" else [STOCK]
    keys = [f'CAST({_column(c)} AS VARCHAR) AS "{c}"' for c in used]
    return star_sql(
        f"SELECT CAST(GROUPING({', '.join(columns)}) AS INTEGER) AS gid, {', '.join(keys + sums)}\n"
        f"{_joins(subject, {_AXIS[c] for c in used})}\nGROUP BY GROUPING SETS ({sets})"
    )
