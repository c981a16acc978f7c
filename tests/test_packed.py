"""Labels of a dimension beyond the broadcast limit, packed by key."""

from __future__ import annotations

import pytest

from bazaarcube.operators.joins import BLOCK_BITS, join_packed, pack_labels
from bazaarcube.plans.cubes import CUBES, build_cube
from bazaarcube.plans.lattice import KeyCells, build_cubes, open_cube
from bazaarcube.session import new_folder
from bazaarcube.sinks.warehouse import Star
from tests.conftest import values

NAMES = ("cube_3d_quy_loai_kh_ma_mh", "cube_2d_ma_mh_thanhpho", "cube_2d_loai_kh_bang", "cube_1d_loai_kh", "inv_cube_2d_thang_bang")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def packing(spark):
    """Dimensions are too large to broadcast, but not to be packed."""
    spark.conf.set("bazaarcube.broadcast.rows", "1")
    yield
    spark.conf.unset("bazaarcube.broadcast.rows")


def fresh(star):
    return Star(star.tables, star.rows)


@pytest.mark.parametrize("name", NAMES)
def test_cubes_with_packed_labels_are_the_same(edge_star, packing, name):
    """Unknown customers, customers without an office, equal city names."""
    edge_star.spark.conf.unset("bazaarcube.broadcast.rows")
    expected = values(build_cube(edge_star, CUBES[name]))
    edge_star.spark.conf.set("bazaarcube.broadcast.rows", "1")
    star = fresh(edge_star)
    packed = build_cube(star, CUBES[name])
    assert values(packed) == expected and expected
    assert star._packed and None not in star._packed.values()
    assert "hashpartitioning(sk_khachHang" not in plan(packed) and "hashpartitioning(sk_cuaHang" not in plan(packed)


def test_keys_across_blocks_with_gaps_and_nulls(spark, packing):
    spark.conf.set("bazaarcube.broadcast.rows", "100")
    size = 1 << BLOCK_BITS
    rows = [(k, None if k % 5 == 0 else f"t{k % 3}", k % 2 == 0) for k in (1, 2, 5, size - 1, size, size + 7, 3 * size, 2**31 - 1)]
    lookup = spark.createDataFrame(rows, "k int, label string, placed boolean")
    left = spark.createDataFrame([(k, i) for i, k in enumerate([*[r[0] for r in rows], 1, 3, 2 * size, None, 0])], "k int, i int")
    packed = pack_labels(lookup, "k", len(rows))
    assert values(join_packed(left, packed, "k"), "k", "i", "label", "placed") == values(left.join(lookup, "k"), "k", "i", "label", "placed")


def test_what_is_not_packed(spark, packing):
    lookup = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, label string")
    assert pack_labels(lookup, "k", 3) is None  # a key with two rows
    assert pack_labels(lookup.filter("label = 'a'"), "k", 17) is None  # too many keys


def test_a_cell_with_the_groups_of_a_cube_is_not_grouped_again(edge_star):
    cells = KeyCells.staged(edge_star, "order")
    for name in ("cube_2d_thang_ma_mh", "cube_2d_ma_kh_ma_mh"):
        assert values(cells.cube(CUBES[name])) == values(build_cube(edge_star, CUBES[name]))
        assert "Aggregate" not in plan(cells.exact_cube(CUBES[name]))
    # a quarter has several months
    assert "Aggregate" in plan(cells.exact_cube(CUBES["cube_2d_quy_ma_mh"]))


def test_a_widest_grouping_is_stored_for_several_cubes_only(spark, edge_star, monkeypatch):
    import bazaarcube.plans.lattice as module

    stored = []
    keep = module.stage_at
    monkeypatch.setattr(module, "stage_at", lambda df, path: stored.append((path, df.columns)) or keep(df, path))
    path = new_folder(spark, "cubes")
    for name in build_cubes(edge_star, path, "order", (1, 2)):
        assert values(open_cube(spark, path, CUBES[name])) == values(build_cube(edge_star, CUBES[name])), name
    bases = [set(columns) for p, columns in stored if "/base-" in p]
    assert bases and not any("maMH" in b for b in bases)
