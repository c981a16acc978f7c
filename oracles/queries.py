"""SQL for every registered query."""

from __future__ import annotations

from oracles.sql import (
    GUIDE_CUBES,
    INVENTORY_CUBES,
    ORDER_CUBES,
    QUANTITY,
    REVENUE,
    cube_sql,
    lattice_sql,
    source_sql,
    star_sql,
)

_SOURCE_NAMES = (
    "vanphongdaidien", "mathang", "khachhang", "khachhang_dulich", "khachhang_buudien", "cuahang",
    "mathang_duoctru",
)
_TABLES = {
    "dim_thoigian": "dim_thoigian",
    "dim_mathang": "dim_mathang",
    "dim_diadiem": "dim_diadiem",
    "dim_khachhang": "dim_khachhang",
    "dim_cuahang": "dim_cuahang",
    "fact_tonkho": "fact_tonkho",
}
_STORES = """,
noi_ban AS (
  SELECT DISTINCT f."sk_matHang", c."maCH", l."tenThanhPho"
  FROM fact_tonkho f JOIN dim_cuahang c ON c."sk_cuaHang" = f."sk_cuaHang"
  LEFT JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"
  WHERE f."soLuongTonKho" > 0)
"""


def _extracts() -> dict[str, str]:
    sql = {f"extract_{name}": source_sql(f"SELECT * FROM {name}") for name in _SOURCE_NAMES}
    sql["extract_dondathang"] = source_sql(
        "SELECT madon, ngaydathang, khachhangmakh, tenkh, vanphongdaidienmatp "
        "FROM dondathang JOIN khachhang ON khachhangmakh = makh"
    )
    sql["extract_mathang_duocdat"] = source_sql(
        """SELECT soluongdat, CAST(giadat AS DOUBLE) AS giadat, mathangmamh, dondathangmadon,
                  tenmh, mota, kichco, trongluong, ngaydathang, khachhangmakh
           FROM mathang_duocdat JOIN mathang ON mathangmamh = mamh
           JOIN dondathang ON dondathangmadon = madon"""
    )
    counts = [f"SELECT '{t}' AS bang, COUNT(*) AS so_dong FROM {t}" for t in _SOURCE_NAMES]
    counts.append("SELECT 'dondathang', COUNT(*) FROM dondathang JOIN khachhang ON khachhangmakh = makh")
    counts.append(
        "SELECT 'mathang_duocdat', COUNT(*) FROM mathang_duocdat JOIN mathang ON mathangmamh = mamh "
        "JOIN dondathang ON dondathangmadon = madon"
    )
    sql["extract_counts"] = source_sql(" UNION ALL ".join(counts))
    return sql


def _star() -> dict[str, str]:
    sql = {name: star_sql(f"SELECT * FROM {table}") for name, table in _TABLES.items()}
    sql["fact_dondathang"] = star_sql(
        """SELECT "sk_khachHang", "sk_matHang", "sk_thoiGian", "maDon", "soLuongDat",
                  CAST("giaDat" AS DOUBLE) AS "giaDat", CAST("thanhTien" AS DOUBLE) AS "thanhTien"
           FROM fact_dondathang"""
    )
    counts = [
        ("Dim_ThoiGian", "dim_thoigian"), ("Dim_DiaDiem", "dim_diadiem"), ("Dim_MatHang", "dim_mathang"),
        ("Dim_KhachHang", "dim_khachhang"), ("Dim_CuaHang", "dim_cuahang"),
        ("Fact_DonDatHang", "fact_dondathang"), ("Fact_TonKho", "fact_tonkho"),
    ]
    sql["row_counts"] = star_sql(
        " UNION ALL ".join(f"SELECT '{name}' AS bang, COUNT(*) AS so_dong FROM {t}" for name, t in counts)
    )
    office = 'l."maTP", l."tenThanhPho", l.mien, l."diaChiVP"'
    sql["dim_cuahang_denorm"] = star_sql(
        f'SELECT c.*, {office} FROM dim_cuahang c LEFT JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"'
    )
    sql["dim_khachhang_denorm"] = star_sql(
        f'SELECT c.*, {office} FROM dim_khachhang c LEFT JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"'
    )
    sql["calendar_day_names"] = star_sql("SELECT *, DAYNAME(ngay) AS thu FROM dim_thoigian")
    sql["time_key_parts"] = star_sql(
        """SELECT f."maDon", f."sk_thoiGian", o.ngaydathang AS ngay, CAST(YEAR(o.ngaydathang) AS INTEGER) AS nam,
                  CAST(MONTH(o.ngaydathang) AS INTEGER) AS thang, CAST(DAY(o.ngaydathang) AS INTEGER) AS ngay_trong_thang
           FROM fact_dondathang f JOIN dondathang o ON o.madon = f."maDon" """
    )
    return sql


def _quality() -> dict[str, str]:
    keys = [
        ("vanphongdaidien", "matp"), ("cuahang", "mach"), ("mathang", "mamh"),
        ("mathang_duoctru", "mathangmamh, cuahangmach"), ("khachhang", "makh"),
        ("khachhang_dulich", "khachhangmakh"), ("khachhang_buudien", "khachhangmakh"),
        ("dondathang", "madon"), ("mathang_duocdat", "mathangmamh, dondathangmadon"),
    ]
    primary = " UNION ALL ".join(
        f"""SELECT '{t}' AS bang, COUNT(*) AS so_khoa_loi, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS so_dong_loi
            FROM (SELECT {k}, COUNT(*) AS n FROM {t} GROUP BY {k} HAVING COUNT(*) > 1)"""
        for t, k in keys
    )
    references = [
        ("cuahang", "vanphongdaidienmatp", "vanphongdaidien", "matp"),
        ("mathang_duoctru", "mathangmamh", "mathang", "mamh"),
        ("mathang_duoctru", "cuahangmach", "cuahang", "mach"),
        ("khachhang", "vanphongdaidienmatp", "vanphongdaidien", "matp"),
        ("khachhang_dulich", "khachhangmakh", "khachhang", "makh"),
        ("khachhang_buudien", "khachhangmakh", "khachhang", "makh"),
        ("dondathang", "khachhangmakh", "khachhang", "makh"),
        ("mathang_duocdat", "mathangmamh", "mathang", "mamh"),
        ("mathang_duocdat", "dondathangmadon", "dondathang", "madon"),
    ]
    foreign = " UNION ALL ".join(
        f"""SELECT '{c}' AS bang, '{col}' AS cot, '{p}' AS bang_cha,
                   COUNT(DISTINCT {col}) AS so_khoa_loi, COUNT(*) AS so_dong_loi
            FROM {c} WHERE {col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{key} = {c}.{col})"""
        for c, col, p, key in references
    )
    return {
        "dq_duplicate_keys": source_sql(primary),
        "dq_orphans": source_sql(foreign),
        "recon_revenue_by_state": source_sql(
            """SELECT mien, CAST(SUM(CAST(soluongdat AS DECIMAL(10,0)) * giadat) AS DOUBLE) AS "doanhThuNguon",
                      CAST(SUM(CAST(soluongdat AS DECIMAL(10,0)) * giadat) AS DOUBLE) AS "doanhThuKho", TRUE AS khop
               FROM mathang_duocdat JOIN dondathang ON madon = dondathangmadon
               JOIN khachhang ON makh = khachhangmakh
               JOIN vanphongdaidien ON matp = vanphongdaidienmatp GROUP BY mien"""
        ),
        "recon_order_lines": source_sql(
            """SELECT CAST(madon AS VARCHAR) AS "maDon", CAST(mamh AS VARCHAR) AS "maMH", n AS "soLuongDat",
                 CAST(gia AS DOUBLE) AS "giaDat", CASE WHEN SUM(d) > 0 THEN 'trai' ELSE 'phai' END AS phia,
                 CAST(ABS(SUM(d)) AS BIGINT) AS "soLan"
               FROM (SELECT dondathangmadon AS madon, mathangmamh AS mamh, soluongdat AS n, giadat AS gia, 1 AS d FROM mathang_duocdat
                 UNION ALL
                 SELECT dondathangmadon, mathangmamh, soluongdat + CASE WHEN dondathangmadon % 1000 = 0 THEN 1 ELSE 0 END, giadat,
                   CASE WHEN dondathangmadon % 501 = 0 AND mathangmamh % 2 = 0 THEN -2 ELSE -1 END
                 FROM mathang_duocdat WHERE dondathangmadon % 777 <> 0)
               GROUP BY madon, mamh, n, gia HAVING SUM(d) <> 0"""
        ),
        "nan_to_null_products": source_sql(
            "SELECT mamh, CASE WHEN mamh % 7 <> 0 THEN CAST(gia AS DOUBLE) END AS trongluong FROM mathang"
        ),
        "quarantined_order_lines": star_sql(
            """SELECT 'missing ' || array_to_string(list_filter([
                   CASE WHEN t IS NULL THEN 'sk_thoiGian' END, CASE WHEN k IS NULL THEN 'sk_khachHang' END,
                   CASE WHEN p IS NULL THEN 'sk_matHang' END], lambda x: x IS NOT NULL), ', ') AS "lyDo",
                 COUNT(*) AS "soDong", CAST(SUM(n) AS BIGINT) AS "soLuong"
               FROM (SELECT "sk_thoiGian" AS t, "soLuongDat" AS n,
                       CASE WHEN "sk_khachHang" % 10 <> 0 THEN "sk_khachHang" END AS k,
                       CASE WHEN "sk_matHang" % 9 <> 0 THEN "sk_matHang" END AS p FROM fact_dondathang)
               WHERE t IS NULL OR k IS NULL OR p IS NULL GROUP BY 1"""
        ),
        "logged_run": star_sql(
            f"""SELECT 'etl' AS job_name, 'SUCCESS' AS status,
                 {" + ".join(f"(SELECT COUNT(*) FROM {t})" for t in _SOURCE_TABLES)} AS records_extracted,
                 {" + ".join(f"(SELECT COUNT(*) FROM {t})" for t in _STAR_TABLES)} AS records_loaded"""
        ),
        "insert_if_absent_overlap": source_sql(
            """SELECT mathangmamh, dondathangmadon, soluongdat, CAST(giadat AS DOUBLE) AS giadat
               FROM mathang_duocdat WHERE dondathangmadon % 3 <> 0
               UNION ALL
               SELECT mathangmamh, dondathangmadon, x.s + 1000, CAST(x.g AS DOUBLE) FROM (
                 SELECT mathangmamh, dondathangmadon, MIN({'s': soluongdat, 'g': giadat}) AS x
                 FROM mathang_duocdat WHERE dondathangmadon % 3 = 0 GROUP BY mathangmamh, dondathangmadon)"""
        ),
        "insert_if_absent_order_lines": source_sql(
            """SELECT mathangmamh, dondathangmadon, MIN(soluongdat) AS soluongdat
               FROM mathang_duocdat GROUP BY mathangmamh, dondathangmadon"""
        ),
    }


_SOURCE_TABLES = (
    "vanphongdaidien", "cuahang", "mathang", "khachhang", "khachhang_dulich", "khachhang_buudien", "dondathang",
    "mathang_duocdat", "mathang_duoctru",
)
_STAR_TABLES = (
    "dim_thoigian", "dim_diadiem", "dim_mathang", "dim_khachhang", "dim_cuahang", "fact_dondathang", "fact_tonkho",
)


def _reports() -> dict[str, str]:
    month = (
        'SELECT t.thang, t.nam, CAST(SUM(f."thanhTien") AS DOUBLE) AS "tongDoanhThu" '
        'FROM fact_dondathang f JOIN dim_thoigian t ON t."sk_thoiGian" = f."sk_thoiGian" GROUP BY t.thang, t.nam'
    )
    both = "SELECT khachhangmakh AS \"maKH\" FROM khachhang_dulich {} SELECT khachhangmakh FROM khachhang_buudien"
    return {
        "report_01_revenue_by_month": star_sql(month),
        "report_02_top_products": star_sql(
            """SELECT m."maMH", m."tenMH", CAST(SUM(f."soLuongDat") AS BIGINT) AS "tongSoLuong",
                      CAST(SUM(f."thanhTien") AS DOUBLE) AS "tongTien"
               FROM fact_dondathang f JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang"
               GROUP BY m."maMH", m."tenMH" ORDER BY SUM(f."thanhTien") DESC, m."maMH" LIMIT 10"""
        ),
        "report_03_customer_types": star_sql(
            """SELECT k."loaiKhachHang", COUNT(DISTINCT f."sk_khachHang") AS "soKhachHang",
                      CAST(SUM(f."thanhTien") AS DOUBLE) AS "tongDoanhThu"
               FROM fact_dondathang f JOIN dim_khachhang k ON k."sk_khachHang" = f."sk_khachHang"
               GROUP BY k."loaiKhachHang" """
        ),
        "report_04_stock_by_store": star_sql(
            """SELECT c."maCH", l."tenThanhPho", m."maMH", m."tenMH", f."sk_thoiGian", f."soLuongTonKho"
               FROM fact_tonkho f JOIN dim_cuahang c ON c."sk_cuaHang" = f."sk_cuaHang"
               LEFT JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"
               JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang" WHERE f."soLuongTonKho" > 0"""
        ),
        "report_05_products_on_sale": star_sql(
            """SELECT l."tenThanhPho", l.mien, c."soDienThoai", m."moTa", m."kichCo", m."trongLuong", m.gia
               FROM fact_tonkho f JOIN dim_cuahang c ON c."sk_cuaHang" = f."sk_cuaHang"
               LEFT JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"
               JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang" WHERE f."soLuongTonKho" > 0"""
        ),
        "report_06_orders_per_customer": star_sql(
            """SELECT k."tenKH", f."maDon", t.ngay FROM fact_dondathang f
               JOIN dim_khachhang k ON k."sk_khachHang" = f."sk_khachHang"
               JOIN dim_thoigian t ON t."sk_thoiGian" = f."sk_thoiGian" """
        ),
        "report_06_orders_per_customer_distinct": source_sql(
            """SELECT DISTINCT tenkh AS "tenKH", madon AS "maDon", ngaydathang AS ngay
               FROM mathang_duocdat JOIN dondathang ON madon = dondathangmadon
               JOIN khachhang ON makh = khachhangmakh"""
        ),
        "report_07_stores_for_customer": star_sql(
            """SELECT c."maCH", l."tenThanhPho", c."soDienThoai" FROM dim_cuahang c
               LEFT JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"
               WHERE c."sk_cuaHang" IN (
                 SELECT s."sk_cuaHang" FROM fact_tonkho s WHERE s."soLuongTonKho" > 0 AND s."sk_matHang" IN (
                   SELECT f."sk_matHang" FROM fact_dondathang f
                   JOIN dim_khachhang k ON k."sk_khachHang" = f."sk_khachHang" WHERE k."maKH" = 7))"""
        ),
        "report_08_office_stock_above": star_sql(
            """SELECT l."maTP", l."diaChiVP", l."tenThanhPho", l.mien,
                      CAST(SUM(f."soLuongTonKho") AS BIGINT) AS "tongTonKho"
               FROM fact_tonkho f JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang"
               JOIN dim_cuahang c ON c."sk_cuaHang" = f."sk_cuaHang"
               JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"
               WHERE m."maMH" = 10 GROUP BY l."maTP", l."diaChiVP", l."tenThanhPho", l.mien
               HAVING SUM(f."soLuongTonKho") > 50"""
        ),
        "report_09_order_sourcing": star_sql(
            """SELECT f."maDon", m."maMH", m."moTa", n."maCH", n."tenThanhPho" FROM fact_dondathang f
               JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang"
               JOIN noi_ban n ON n."sk_matHang" = f."sk_matHang" """,
            _STORES,
        ),
        "report_09_order_sourcing_sets": star_sql(
            """SELECT 'dong' AS phan, m."maMH", f."maDon", NULL AS "moTa", NULL AS "maCH", NULL AS "tenThanhPho"
               FROM fact_dondathang f JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang"
               UNION ALL SELECT 'cung', m."maMH", NULL, m."moTa", n."maCH", n."tenThanhPho"
               FROM noi_ban n JOIN dim_mathang m ON m."sk_matHang" = n."sk_matHang" """,
            _STORES,
        ),
        "report_09_order_sourcing_one": star_sql(
            """SELECT f."maDon", m."maMH", m."moTa", n."maCH", n."tenThanhPho" FROM fact_dondathang f
               JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang"
               JOIN noi_ban n ON n."sk_matHang" = f."sk_matHang" WHERE f."maDon" = 5""",
            _STORES,
        ),
        "report_10_customer_place": star_sql(
            """SELECT k."maKH", k."tenKH", l."tenThanhPho", l.mien FROM dim_khachhang k
               LEFT JOIN dim_diadiem l ON l."sk_diaDiem" = k."sk_diaDiem" WHERE k."maKH" = 7"""
        ),
        "report_11_stock_in_city": star_sql(
            """SELECT c."maCH", m."moTa", CAST(SUM(f."soLuongTonKho") AS BIGINT) AS "tongTonKho"
               FROM fact_tonkho f JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang"
               JOIN dim_cuahang c ON c."sk_cuaHang" = f."sk_cuaHang"
               JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"
               WHERE m."maMH" = 10 AND l."tenThanhPho" = 'NATION_16' GROUP BY c."maCH", m."moTa" """
        ),
        "report_12_order_detail": star_sql(
            """SELECT f."maDon", m."maMH", m."tenMH", f."soLuongDat", k."maKH", k."tenKH", n."maCH", n."tenThanhPho"
               FROM fact_dondathang f JOIN dim_mathang m ON m."sk_matHang" = f."sk_matHang"
               LEFT JOIN dim_khachhang k ON k."sk_khachHang" = f."sk_khachHang"
               LEFT JOIN noi_ban n ON n."sk_matHang" = f."sk_matHang" WHERE f."maDon" = 5""",
            _STORES,
        ),
        "report_13_customer_groups": star_sql(
            """SELECT "maKH", "tenKH", 'Du lich' AS loai FROM dim_khachhang WHERE "loaiKhachHang" = 'Du lich'
               UNION ALL SELECT "maKH", "tenKH", 'Buu dien' FROM dim_khachhang WHERE "loaiKhachHang" = 'Buu dien'
               UNION ALL SELECT "maKH", "tenKH", 'Ca hai' FROM dim_khachhang WHERE "loaiKhachHang" = 'Ca hai'"""
        ),
        "customers_both_intersect": source_sql(both.format("INTERSECT")),
        "customers_travel_only_except": source_sql(both.format("EXCEPT")),
        "customers_postal_only_except": source_sql(
            'SELECT khachhangmakh AS "maKH" FROM khachhang_buudien EXCEPT SELECT khachhangmakh FROM khachhang_dulich'
        ),
        "rollup_geo": star_sql(
            """SELECT l.mien, l."tenThanhPho", CAST(c."maCH" AS VARCHAR) AS "maCH", CAST(SUM(f."soLuongTonKho") AS BIGINT) AS "tongTonKho",
                      CAST(GROUPING(l.mien, l."tenThanhPho", c."maCH") AS INTEGER) AS "capDo"
               FROM fact_tonkho f JOIN dim_cuahang c ON c."sk_cuaHang" = f."sk_cuaHang"
               JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"
               GROUP BY ROLLUP (l.mien, l."tenThanhPho", c."maCH")"""
        ),
        "drilldown_month_in_state": cube_sql(
            "order", ["mien", "tenThanhPho", "nam", "thang"], where="WHERE l.mien = 'ASIA'"
        ),
        "drilldown_stores_in_city": cube_sql(
            "inventory", ["tenThanhPho", "maCH", "nam", "thang"], where="WHERE l.\"tenThanhPho\" = 'NATION_16'"
        ),
        "slice_customer": cube_sql("order", ["nam", "thang", "maKH"], where='WHERE c."maKH" = 7'),
        "slice_product": cube_sql("order", ["nam", "thang", "maMH"], where='WHERE p."maMH" = 10'),
        "slice_city": cube_sql("order", ["nam", "thang", "tenThanhPho"], where="WHERE l.\"tenThanhPho\" = 'NATION_16'"),
        "slice_customer_type": cube_sql(
            "order", ["nam", "thang", "loaiKhachHang"], where="""WHERE c."loaiKhachHang" = 'Du lich'"""
        ),
        "dice_type_city_month": cube_sql(
            "order",
            ["nam", "thang", "maMH", "tenThanhPho", "loaiKhachHang"],
            where="""WHERE p."maMH" = 10 AND l."tenThanhPho" = 'NATION_16' AND t.thang = 3""",
        ),
        "stock_latest_snapshot": star_sql(
            """SELECT "sk_cuaHang", "sk_matHang", "sk_thoiGian", "soLuongTonKho" FROM (
                 SELECT *, ROW_NUMBER() OVER (PARTITION BY "sk_cuaHang", "sk_matHang"
                                              ORDER BY "sk_thoiGian" DESC) AS thu_tu2 FROM fact_tonkho)
               WHERE thu_tu2 = 1"""
        ),
    }


# Customers known on the first day: registered in a subtype, or with an order
# until then. On the second day all are known, with their first order.
_SCD = """
WITH lan_dau AS (
  SELECT c_custkey, c_name, MIN(CAST(o_orderdate AS DATE)) AS d
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name),
cu AS (
  SELECT c_custkey AS k, c_name AS ten, CASE WHEN d <= DATE '1995-12-31' THEN d END AS d
  FROM lan_dau WHERE c_custkey % 10 < 3 OR c_custkey % 4 = 0 OR d <= DATE '1995-12-31'),
cu_so AS (SELECT *, ROW_NUMBER() OVER (ORDER BY k) AS sk FROM cu),
mo AS (
  SELECT n.c_custkey AS k, n.c_name AS ten, n.d FROM lan_dau n LEFT JOIN cu c ON c.k = n.c_custkey
  WHERE c.k IS NULL OR c.d IS DISTINCT FROM n.d)
SELECT CAST(c.sk AS INTEGER) AS "sk_khachHang", c.k AS "maKH", c.ten AS "tenKH", c.d AS "ngayDatHangDauTien",
       DATE '1995-12-31' AS "hieuLucTu",
       CASE WHEN n.d IS DISTINCT FROM c.d THEN DATE '2001-12-31' END AS "hieuLucDen",
       n.d IS NOT DISTINCT FROM c.d AS "laHienTai"
FROM cu_so c JOIN lan_dau n ON n.c_custkey = c.k
UNION ALL
SELECT CAST((SELECT COUNT(*) FROM cu) + ROW_NUMBER() OVER (ORDER BY k) AS INTEGER), k, ten, d,
       DATE '2001-12-31', CAST(NULL AS DATE), TRUE
FROM mo
"""


def _two_loads() -> dict[str, str]:
    """Members that the first load knows are numbered first, all others after them."""

    def keyed(table: str, key: str, known: str) -> str:
        return f"""SELECT {key} AS ma, CAST(ROW_NUMBER() OVER (PARTITION BY {known} ORDER BY {key})
          + CASE WHEN {known} THEN 0 ELSE (SELECT COUNT(*) FROM {table} WHERE {known}) END AS INTEGER) AS sk FROM {table}"""

    mh, kh = keyed("mathang", "mamh", "(mamh % 5 <> 2)"), keyed("khachhang", "makh", "(makh % 7 <> 3)")
    tp, ch = keyed("vanphongdaidien", "matp", "true"), keyed("cuahang", "mach", "true")
    return {
        "incremental_star": source_sql(
            f"""SELECT k.sk AS "sk_khachHang", m.sk AS "sk_matHang", CAST(STRFTIME(ngaydathang, '%Y%m%d') AS INTEGER) AS "sk_thoiGian",
                  madon AS "maDon", soluongdat AS "soLuongDat", CAST(giadat AS DOUBLE) AS "giaDat",
                  CAST(CAST(soluongdat AS DECIMAL(10,0)) * giadat AS DOUBLE) AS "thanhTien"
                FROM mathang_duocdat JOIN dondathang ON madon = dondathangmadon
                JOIN ({mh}) m ON m.ma = mathangmamh LEFT JOIN ({kh}) k ON k.ma = khachhangmakh"""
        ),
        "incremental_star_stock": source_sql(
            f"""SELECT CAST(STRFTIME(thoigiannhap, '%Y%m%d') AS INTEGER) AS "sk_thoiGian", m.sk AS "sk_matHang", c.sk AS "sk_cuaHang",
                  MAX(soluongtrongkho) AS "soLuongTonKho"
                FROM mathang_duoctru JOIN ({mh}) m ON m.ma = mathangmamh JOIN ({ch}) c ON c.ma = cuahangmach
                GROUP BY thoigiannhap, m.sk, c.sk"""
        ),
        "incremental_star_members": source_sql(
            " UNION ALL ".join(
                f"SELECT '{t}' AS bang, CAST(ma AS VARCHAR) AS ma, sk AS khoa FROM ({q})"
                for t, q in (("Dim_MatHang", mh), ("Dim_DiaDiem", tp), ("Dim_KhachHang", kh), ("Dim_CuaHang", ch))
            )
        ),
    }


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for name, group in ORDER_CUBES.items():
        sql[name] = cube_sql("order", group.split())
    for name, group in INVENTORY_CUBES.items():
        sql[name] = cube_sql("inventory", group.split())
    for name, (subject, group) in GUIDE_CUBES.items():
        sql[name] = cube_sql(subject, group.split(), count=subject == "order")
    sql.update(_extracts())
    sql.update(_star())
    sql.update(_quality())
    sql.update(_reports())
    sql.update(_two_loads())
    sql["lattice_order"] = lattice_sql("order", ORDER_CUBES)
    sql["lattice_inventory"] = lattice_sql("inventory", INVENTORY_CUBES)
    sql["cube_incremental"] = cube_sql("order", ["nam", "quy", "mien", "tenThanhPho"])
    sql["cube_incremental_inventory"] = cube_sql("inventory", ["nam", "thang", "tenThanhPho"])
    sql["cube_backfill_stream_compact"] = cube_sql("order", ["nam", "quy", "mien", "tenThanhPho"])
    sql["inventory_corrected_stream"] = cube_sql("inventory", ["nam", "thang", "tenThanhPho"])
    sql["inventory_corrected_stream_day"] = cube_sql("inventory", ["maCH", "ngay"])
    sql["cube_incremental_day"] = cube_sql("order", ["ngay"], count=True)
    sql["cube_2d_product_time_stored"] = cube_sql("order", ["maMH", "ngay"], count=True)
    sql["inv_cube_3d_store_product_time_stored"] = cube_sql("inventory", ["maCH", "maMH", "ngay"])
    sql["cube_resolved_day"] = cube_sql("order", ["ngay"], count=True)
    sql["cube_resolved"] = cube_sql("order", ["loaiKhachHang"])
    sql["slice_city_stored"] = sql["slice_city"]
    sql["drilldown_month_in_state_stored"] = sql["drilldown_month_in_state"]
    sql["rollup_quarter_of_regions_stored"] = star_sql(
        """SELECT t.nam, t.quy, CAST(SUM(f."soLuongTonKho") AS BIGINT) AS "tongTonKho"
           FROM fact_tonkho f JOIN dim_thoigian t ON t."sk_thoiGian" = f."sk_thoiGian"
           JOIN dim_cuahang c ON c."sk_cuaHang" = f."sk_cuaHang" JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem"
           WHERE l.mien IN ('ASIA', 'EUROPE') GROUP BY t.nam, t.quy"""
    )
    sql["report_03_customer_types_stored"] = sql["report_03_customer_types"]
    sql["distinct_customers_by_quarter_region"] = star_sql(
        f"""SELECT t.nam, t.quy, l.mien, COUNT(DISTINCT f."sk_khachHang") AS "soKhachHang", {REVENUE}, {QUANTITY}
           FROM fact_dondathang f JOIN dim_thoigian t ON t."sk_thoiGian" = f."sk_thoiGian"
           JOIN dim_khachhang c ON c."sk_khachHang" = f."sk_khachHang"
           JOIN dim_diadiem l ON l."sk_diaDiem" = c."sk_diaDiem" GROUP BY t.nam, t.quy, l.mien"""
    )
    sql["preview_products"] = star_sql('SELECT * FROM dim_mathang ORDER BY "sk_matHang" LIMIT 5')
    sql["scd2_customer"] = _SCD
    return sql
