from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaarcube.plans import lattice
from bazaarcube.plans.cubes import CUBES, LINES, build_cube, guide_specs, specs_for
from bazaarcube.plans.lattice import answer_from_cube, build_cubes, open_cube
from bazaarcube.session import new_folder
from bazaarcube.streaming.cube_stream import backfill, compact, read_cube, write_batch
from tests.conftest import values

MONTHS = ["cube_1d_thang", "cube_2d_thang_ma_mh", "cube_2d_nam_bang", "cube_1d_ma_mh", "cube_0d"]
MIXED = {
    "order": [*guide_specs("order"), *[CUBES[n] for n in MONTHS]],
    "inventory": [*guide_specs("inventory"), CUBES["inv_cube_2d_thang_mathang"], CUBES["inv_cube_1d_bang"]],
}


@pytest.mark.parametrize("pays", [True, False])
@pytest.mark.parametrize("subject", ["order", "inventory"])
def test_stored_day_and_month_cubes(spark, edge_star, monkeypatch, subject, pays):
    """Together with cubes by month, whether or not the widest cells are stored."""
    monkeypatch.setattr(lattice, "widest_cell_pays", lambda *args, **more: pays)
    path = new_folder(spark, "cubes")
    names = build_cubes(edge_star, path, subject, dims=(1,), more=guide_specs(subject))
    assert set(names) == {s.name for s in (*specs_for(subject, (1,)), *guide_specs(subject))}
    for name in names:
        assert values(open_cube(spark, path, CUBES[name])) == values(build_cube(edge_star, CUBES[name])), name


@pytest.mark.parametrize("subject", ["order", "inventory"])
def test_batches_by_day(spark, edge_star, subject):
    fact = {"order": "Fact_DonDatHang", "inventory": "Fact_TonKho"}[subject]
    specs, path, target = MIXED[subject], new_folder(spark, "partial"), new_folder(spark, "compacted")
    half = F.pmod(F.xxhash64(*edge_star[fact].columns), F.lit(2))
    for batch in (0, 1, 0):
        write_batch(edge_star, edge_star[fact].filter(half == batch), specs, path, batch)
    compact(edge_star, path, target, specs)
    for folder in (path, target):
        for spec in specs:
            assert values(read_cube(edge_star, folder, spec, specs)) == values(build_cube(edge_star, spec)), spec.name


def test_backfill_by_day(spark, edge_star):
    specs, path = MIXED["order"], new_folder(spark, "partial")
    backfill(edge_star, specs, path)
    for spec in specs:
        assert values(read_cube(edge_star, path, spec, specs)) == values(build_cube(edge_star, spec)), spec.name


def test_counts_are_answered_only_by_cubes_that_count(spark, edge_star):
    path = new_folder(spark, "cubes")
    names = build_cubes(edge_star, path, "order", dims=(1,), more=guide_specs("order"))
    rows = {name: spark.read.parquet(f"{path}/{name}").count() for name in names}
    name, answer = answer_from_cube(spark, path, "order", ["maMH"], rows, (LINES,))
    assert name == "cube_1d_product" and values(answer) == values(build_cube(edge_star, CUBES[name]))
    assert answer_from_cube(spark, path, "order", ["ngay"], rows)[0] == "cube_1d_time"
    with pytest.raises(LookupError):
        answer_from_cube(spark, path, "order", ["nam", "thang"], rows, (LINES,))
