from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaarcube.plans.cubes import CubeSpec, CUBES, GUIDE_CUBES, INVENTORY_CUBES, ORDER_CUBES, build_cube, specs_for
from bazaarcube.plans.lattice import (
    KeyCells, answer_from_cube, build_cubes, build_lattice, cube_exists, lattice_cube, lattice_columns, spec_gid,
    widest_cell_pays,
)
from bazaarcube.plans.star import star_for_testdata
from bazaarcube.session import new_folder
from oracles import sql as oracle
from tests.conftest import TESTDATA, values


def plan_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_specs_are_the_documented_cubes():
    assert {s.name: " ".join(s.group) for s in ORDER_CUBES} == oracle.ORDER_CUBES
    assert {s.name: " ".join(s.group) for s in INVENTORY_CUBES} == oracle.INVENTORY_CUBES
    assert {s.name: (s.subject, " ".join(s.group)) for s in GUIDE_CUBES} == oracle.GUIDE_CUBES
    assert [sum(s.dims == d for s in ORDER_CUBES) for d in range(4)] == [1, 8, 23, 28]
    assert [sum(s.dims == d for s in INVENTORY_CUBES) for d in range(4)] == [1, 6, 11, 0]


@pytest.mark.parametrize(
    "cube, expected",
    [
        ("cube_0d", [(1875000.0, 35)]),
        ("cube_1d_ma_mh", [("MH2", 1500000.0, 30), ("MH3", 375000.0, 5)]),
        (
            "cube_1d_ma_kh",
            [("KH5", "Khong phan loai", 875000.0, 15), ("KH8", "Khong phan loai", 1000000.0, 20)],
        ),
        ("cube_1d_nam", [(2025, 1875000.0, 35)]),
        ("cube_1d_quy", [(2025, 1, 1875000.0, 35)]),
        ("cube_1d_thang", [(2025, 1, 1875000.0, 35)]),
        ("inv_cube_0d", [(225,)]),
        ("inv_cube_1d_mathang", [("MH2", 125), ("MH3", 100)]),
        ("inv_cube_1d_store", [("CH1", 150), ("CH2", 75)]),
    ],
)
def test_worked_examples(golden_star, cube, expected):
    assert values(build_cube(golden_star, CUBES[cube])) == expected


def test_output_types(golden_star):
    assert build_cube(golden_star, CUBES["cube_2d_nam_bang"]).dtypes == [
        ("nam", "int"), ("mien", "string"), ("tongDoanhThu", "double"), ("tongSoLuong", "bigint"),
    ]
    assert build_cube(golden_star, CUBES["inv_cube_1d_bang"]).dtypes == [("mien", "string"), ("tongTonKho", "bigint")]


def test_cities_and_regions(edge_star):
    """Order cubes tell one city name in two regions apart; stock cubes do not.
    Offices in one city are added up; customers without an office drop out."""
    orders = values(build_cube(edge_star, CUBES["cube_1d_thanhpho"]), "mien", "tenThanhPho", "tongSoLuong")
    assert orders == [("Mien Bac", "Ha Noi", 2), ("Mien Nam", "Ha Noi", 6), ("Mien Trung", "Hue", 18)]
    assert values(build_cube(edge_star, CUBES["inv_cube_1d_thanhpho"])) == [("Ha Noi", 80 + 5), ("Hue", 90)]


def test_products_with_one_name_stay_apart(edge_star):
    rows = values(build_cube(edge_star, CUBES["cube_2d_ma_mh_bang"]), "maMH", "tenMH")
    assert {m for m, name in rows if name == "Ao"} == {"MH0001", "MH0003"}


def test_zero_measures_stay(edge_star):
    rows = build_cube(edge_star, CUBES["cube_3d_thang_ma_kh_ma_mh"])
    assert rows.filter("maKH = 'KH00003' AND maMH = 'MH0001'").first()["tongDoanhThu"] == 0.0


def test_lost_rows_are_the_rows_without_a_key(edge_star):
    total = build_cube(edge_star, CUBES["cube_0d"]).first()["tongSoLuong"]
    by_customer = build_cube(edge_star, CUBES["cube_1d_ma_kh"]).agg(F.sum("tongSoLuong")).first()[0]
    lost = edge_star["Fact_DonDatHang"].filter("sk_khachHang IS NULL").agg(F.sum("soLuongDat")).first()[0]
    assert total - by_customer == lost == 12


def test_empty_fact(spark, edge_star):
    from bazaarcube.sinks.warehouse import Star

    empty = Star({**edge_star.tables, "Fact_DonDatHang": edge_star["Fact_DonDatHang"].limit(0)}, edge_star.rows)
    assert values(build_cube(empty, CUBES["cube_0d"])) == [(None, None)]
    assert build_cube(empty, CUBES["cube_1d_nam"]).count() == 0


@pytest.mark.parametrize(
    "cube",
    ["cube_1d_bang", "cube_2d_nam_loai_kh", "cube_2d_ma_kh_ma_mh", "cube_3d_quy_ma_mh_thanhpho",
     "cube_2d_product_time", "inv_cube_2d_mathang_thanhpho"],
)
def test_large_dimensions_give_the_same_cube(edge_star, cube, tiny_broadcast):
    large = values(build_cube(edge_star, CUBES[cube]))
    edge_star.spark.conf.unset("bazaarcube.broadcast.rows")
    assert large == values(build_cube(edge_star, CUBES[cube])) and large


@pytest.mark.parametrize(
    "cube, sums",
    [
        ("cube_2d_nam_bang", 2),  # per customer, then per region
        ("cube_2d_ma_kh_ma_mh", 1),  # both ids are in the group: labels come last
        ("cube_3d_nam_ma_mh_bang", 2),
    ],
)
def test_large_dimensions_are_joined_after_summing(edge_star, cube, sums, tiny_broadcast):
    plan = plan_text(build_cube(edge_star, CUBES[cube]))
    assert sum("Aggregate [" in line for line in plan.splitlines()) == sums, plan


def test_repeated_ids_are_grouped_by_label(spark, edge_star):
    """With two versions of each customer, the id no longer names one key."""
    from bazaarcube.sinks.warehouse import Star

    versions = edge_star["Dim_KhachHang"].withColumn("maKH", F.lit("KH"))
    star = Star({**edge_star.tables, "Dim_KhachHang": versions}, edge_star.rows)
    assert not star.is_unique("Dim_KhachHang", "maKH") and star.is_unique("Dim_MatHang", "maMH")
    rows = build_cube(star, CUBES["cube_2d_nam_ma_kh"])
    by_hand = build_cube(edge_star, CUBES["cube_2d_nam_ma_kh"]).groupBy("nam", "loaiKhachHang").agg(
        F.sum("tongSoLuong").alias("q")
    )
    assert values(rows, "nam", "loaiKhachHang", "tongSoLuong") == values(by_hand)


@pytest.mark.parametrize("subject", ["order", "inventory"])
def test_lattice_holds_every_cube(edge_star, subject):
    specs = specs_for(subject)
    rows = build_lattice(edge_star, subject).collect()
    gids = {s.name: spec_gid(s, lattice_columns(specs)) for s in specs}
    assert len(set(gids.values())) == len(specs)
    assert {r["gid"] for r in rows} == set(gids.values())
    for spec in specs:
        cell = [tuple(r[c] for c in spec.columns) for r in rows if r["gid"] == gids[spec.name]]
        cell.sort(key=lambda r: tuple((v is not None, v) for v in r))
        assert cell == values(build_cube(edge_star, spec)), spec
    frame = edge_star.spark.createDataFrame(rows, build_lattice(edge_star, subject).schema)
    assert values(lattice_cube(frame, specs[-1], specs)) == values(build_cube(edge_star, specs[-1]))


def test_stored_widest_cell_gives_the_same(spark, golden_star, edge_star, monkeypatch):
    """Whether or not the widest sums are worth storing, the cubes agree."""
    import bazaarcube.plans.lattice as module

    for pays in (True, False):
        monkeypatch.setattr(module, "widest_cell_pays", lambda *a: pays)
        cells = KeyCells.staged(edge_star, "order")
        for name in ("cube_0d", "cube_3d_thang_ma_kh_ma_mh", "cube_3d_nam_ma_mh_bang", "cube_1d_loai_kh"):
            assert values(cells.cube(CUBES[name])) == values(build_cube(edge_star, CUBES[name]))
    assert isinstance(widest_cell_pays(edge_star, "order"), bool)


def test_stored_cubes_and_the_resolver(spark, edge_star):
    path = new_folder(spark, "cubes")
    names = build_cubes(edge_star, path, "order", dims=(0, 1, 2))
    build_cubes(edge_star, path, "order", dims=(0, 1, 2))  # a rerun replaces
    assert len(names) == 32
    rows = {name: spark.read.parquet(f"{path}/{name}").count() for name in names}
    used, answer = answer_from_cube(spark, path, "order", ["loaiKhachHang"], rows)
    assert values(answer) == values(build_cube(edge_star, CUBES["cube_1d_loai_kh"]))
    same_facts = [s for s in specs_for("order", (0, 1, 2)) if "loaiKhachHang" in s.group and s.axes == {"sk_khachHang"}]
    assert rows[used] == min(rows[s.name] for s in same_facts if "mien" not in s.group)
    used, answer = answer_from_cube(spark, path, "order", ["mien", "nam"], {"cube_2d_quy_thanhpho": 1})
    assert values(answer, "nam", "mien", "tongDoanhThu", "tongSoLuong") == values(
        build_cube(edge_star, CUBES["cube_2d_nam_bang"])
    )
    with pytest.raises(LookupError):
        answer_from_cube(spark, path, "order", ["maKH", "maMH"], {"cube_0d": 1})
    assert cube_exists(spark, path, "cube_0d") and not cube_exists(spark, path, "cube_3d")


def test_child_cells_add_up_to_their_parents(spark):
    star = star_for_testdata(spark, TESTDATA)
    total = build_cube(star, CUBES["cube_0d"]).first()
    for name in ("cube_1d_thang", "cube_2d_ma_kh_ma_mh", "cube_3d_quy_ma_mh_thanhpho", "cube_3d_nam_loai_kh_bang"):
        summed = build_cube(star, CUBES[name]).agg(
            F.sum(F.col("tongDoanhThu").cast("decimal(38,2)")), F.sum("tongSoLuong")
        ).first()
        assert (float(summed[0]), summed[1]) == (total[0], total[1])


def test_every_answer_from_stored_cubes_is_complete(spark, edge_star):
    """Facts without a customer, office or day are in some cubes only: an answer must
    not depend on which cubes are stored."""
    path = new_folder(spark, "cubes")
    names = build_cubes(edge_star, path, "order", dims=(0, 1, 2))
    assert cube_exists(spark, path, names[0]) and not cube_exists(spark, path, "cube_3d_nam_loai_kh_bang")
    assert dict(spark.read.parquet(f"{path}/cube_1d_nam").dtypes)["tongDoanhThu"] == "decimal(38,2)"
    groups = [["nam"], ["loaiKhachHang"], ["maMH"], ["mien"], ["maKH"], [], ["nam", "thang"], ["loaiKhachHang", "nam"]]
    answered = 0
    for group in groups:
        expected = values(build_cube(edge_star, CubeSpec("asked", "order", tuple(group), 0)))
        for stored in (names, [n for n in names if "_2d_" in n], [n for n in names if "bang" in n or "thanhpho" in n]):
            rows = {name: 1 for name in stored}
            try:
                _, answer = answer_from_cube(spark, path, "order", group, rows)
            except LookupError:
                continue
            answered += 1
            assert values(answer) == expected, (group, stored)
    assert answered >= 10


def test_latest_stock_below_zero(spark, edge_star):
    from bazaarcube.plans.olap import latest_stock
    from bazaarcube.sinks.warehouse import Star

    rows = [(20250114, 1, 1, 7), (20250115, 1, 1, -5), (20250115, 2, 1, 0), (20250116, 2, 2, -(2**31)), (20250116, 3, 2, 2**31 - 1)]
    stock = spark.createDataFrame(rows, edge_star["Fact_TonKho"].schema)
    star = Star({**edge_star.tables, "Fact_TonKho": stock}, edge_star.rows)
    got = {tuple(r) for r in latest_stock(star).select("sk_cuaHang", "sk_matHang", "sk_thoiGian", "soLuongTonKho").collect()}
    assert got == {(1, 1, 20250115, -5), (1, 2, 20250115, 0), (2, 2, 20250116, -(2**31)), (2, 3, 20250116, 2**31 - 1)}
