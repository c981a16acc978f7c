from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaarcube.plans import olap, reports
from bazaarcube.plans.cubes import CUBES, CubeSpec, build_cube
from bazaarcube.plans.lattice import build_cubes, quarter_of, same_rows
from bazaarcube.session import new_folder
from tests.conftest import values

QUESTIONS = [
    ("order", ["nam", "thang", "tenThanhPho"], {"tenThanhPho": "Hue"}),
    ("order", ["mien", "tenThanhPho", "nam", "thang"], {"mien": "Mien Bac"}),
    ("order", ["nam", "quy"], {"mien": ["Mien Bac", "Mien Trung"]}),
    ("order", ["loaiKhachHang"], {"nam": 2024}),
    ("order", [], {"maMH": "MH0002"}),
    ("order", ["quy"], {"loaiKhachHang": "Du lich", "thang": [1, 2, 12]}),
    ("order", ["maMH"], {"tenThanhPho": "none such"}),
    ("inventory", ["nam", "quy", "tenThanhPho"], {"quy": 1}),
    ("inventory", ["maMH"], {"mien": ("Mien Bac", "Mien Nam")}),
]


def direct(star, subject, group, where):
    """Facts by all asked columns, then filtered and summed in Python."""
    asked = tuple(dict.fromkeys((*group, *where)))
    cube = build_cube(star, CubeSpec("direct", subject, asked, len(asked)))
    sums: dict = {}
    for row in cube.collect():
        if all(row[c] in (v if isinstance(v, (list, tuple)) else [v]) for c, v in where.items()):
            key = tuple(row[c] for c in group)
            sums[key] = [a + b for a, b in zip(sums.get(key, [0] * 9), row[len(asked) :])]
    return sorted(([*k, *[round(x, 6) for x in s]] for k, s in sums.items()), key=str)


@pytest.fixture(scope="module")
def stored(spark, edge_star):
    path = new_folder(spark, "cubes")
    names = [n for subject in ("order", "inventory") for n in build_cubes(edge_star, path, subject)]
    return path, {n: spark.read.parquet(f"{path}/{n}").count() for n in names}


@pytest.mark.parametrize(("subject", "group", "where"), QUESTIONS)
def test_any_covering_cube_gives_the_direct_answer(spark, edge_star, stored, subject, group, where):
    path, rows = stored
    asked = list(dict.fromkeys((*group, *where)))
    fit = [s.name for s in CUBES.values() if s.name in rows and s.subject == subject and set(asked) <= quarter_of(s.group) and same_rows(subject, s, asked)]
    want = direct(edge_star, subject, group, where)
    for only in [*fit[:3], None]:
        cube, found = olap.answer(edge_star, path, subject, group, where, {only: rows[only]} if only else {})
        assert cube == only
        got = sorted(([round(x, 6) if isinstance(x, float) else x for x in r] for r in found.collect()), key=str)
        assert got == want, only
    assert fit


def test_the_smallest_cube_answers_and_is_asked_for_the_value(spark, edge_star, stored):
    path, rows = stored
    cube, found = olap.answer(edge_star, path, "order", ["nam"], {"mien": "Mien Bac"}, rows)
    assert rows[cube] == min(rows[n] for n in ("cube_2d_nam_bang", "cube_2d_quy_bang", "cube_2d_thang_bang"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(mien,Mien Bac)" in plan and "Fact" not in plan


def test_cubes_of_other_facts_do_not_answer(spark, edge_star, stored):
    """Orders without an office, or without a day, are in one cube and not in the other."""
    path, rows = stored
    for group, where, wrong in ((["nam"], {"thang": 1}, "cube_2d_thang_bang"), (["maMH"], {}, "cube_2d_nam_ma_mh")):
        cube, _ = olap.answer(edge_star, path, "order", group, where, {wrong: rows[wrong]})
        assert cube is None


def test_sourcing_sets_unfold_to_the_flat_report(edge_star):
    sets, flat = reports.sourcing_sets(edge_star), reports.order_sourcing(edge_star)
    assert values(reports.unfolded(sets)) == values(flat)
    assert values(reports.unfolded(sets, "DON001")) == values(flat.filter(F.col("maDon") == "DON001"))
    lines, pairs = (sets.filter(F.col("phan") == p).count() for p in (reports.LINE, reports.SUPPLY))
    assert pairs == reports.suppliers(edge_star).filter("sk_matHang is not null and sk_cuaHang is not null").count()
    assert lines == edge_star["Fact_DonDatHang"].filter("sk_matHang is not null").count()
