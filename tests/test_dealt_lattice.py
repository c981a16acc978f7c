"""Cubes with ids where the dimensions are too large to broadcast."""

from __future__ import annotations

import glob
import re

import pytest
from pyspark.sql import functions as F

from bazaarcube.operators.joins import join_packed, pack_labels
from bazaarcube.plans.cubes import specs_for
from bazaarcube.plans.lattice import KeyCells, build_lattice, lattice
from bazaarcube.plans.star import star_for_testdata
from bazaarcube.sinks.warehouse import Star
from tests.conftest import TESTDATA


@pytest.fixture
def large(spark):
    """Customers are too many to broadcast, but not to be packed; products are too many for both."""
    star = star_for_testdata(spark, TESTDATA)
    spark.conf.set("bazaarcube.broadcast.rows", "20")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Star(star.tables, star.rows)
    spark.conf.unset("bazaarcube.broadcast.rows")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def dealt(df) -> list[str]:
    """The columns that rows, not finished sums, are dealt by."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [re.sub(r"#\d+", "", x) for x in re.findall(r"RepartitionByExpression \[([^\]]*)\]", plan)]


def test_rows_are_dealt_twice_for_each_key(spark, large):
    """Once for the cubes with a time and once for those without, whatever their other columns."""
    rows = build_lattice(large, "order")
    assert {x.split(", ")[0] for x in dealt(rows)} == {"sk_khachHang", "sk_matHang"}
    # dealt rows, and the products that are dealt the same way to meet them
    assert len(dealt(rows)) <= 6
    joins = rows._jdf.queryExecution().executedPlan().toString()
    assert joins.count("SortMergeJoin") <= 2  # products only, among the dealt rows
    found = sorted(rows.collect(), key=str)
    spark.conf.unset("bazaarcube.broadcast.rows")
    assert found == sorted(build_lattice(star_for_testdata(spark, TESTDATA), "order").collect(), key=str) and found


def test_a_batch_keeps_its_rows_and_smaller_sums(large):
    """Rows are not shuffled to be kept, nor are sums that are no fewer than the rows."""
    specs = specs_for("order", (0, 1, 2))
    cells = KeyCells.kept(large, specs, large["Fact_DonDatHang"])
    try:
        full = frozenset({"T", "sk_khachHang", "sk_matHang"})
        rows, merged = cells.cells[full]
        assert not merged and "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
        assert cells.rows(full) == large.rows["Fact_DonDatHang"]
        assert frozenset({"sk_khachHang", "sk_matHang"}) not in cells.cells and frozenset({"T"}) in cells.cells
        assert len(dealt(lattice(cells, specs))) <= 6
    finally:
        cells.release()


def test_only_smaller_cells_are_stored(large):
    every, some = KeyCells.staged(large, "order"), KeyCells.staged(large, "order", only_smaller=True)
    assert set(some.cells) < set(every.cells)
    assert frozenset({"sk_khachHang", "sk_matHang"}) not in some.cells  # nearly as many as order lines
    for axes in every.cells:
        assert axes <= some.holding(axes)


def test_integer_ids_are_packed_beside_the_labels(spark, large):
    rows = [(k, None if k == 5 else 10 * k, "ab"[k % 2]) for k in (1, 2, 5, 255, 256, 600)]
    lookup = spark.createDataFrame(rows, "k int, ma bigint, loai string")
    left = spark.createDataFrame([(k,) for k in (1, 5, 256, 600, 3, 9999, None)], "k int")
    packed = pack_labels(lookup, "k", len(rows), ["ma"])
    for how in ("inner", "left"):
        want = sorted(left.join(lookup, "k", how).collect(), key=str)
        assert sorted(join_packed(left, packed, "k", how).select("k", "ma", "loai").collect(), key=str) == want
    assert pack_labels(lookup.withColumn("ma", lookup["ma"].cast("string")), "k", len(rows), ["ma"]) is None


def test_compaction_shuffles_the_sums_once(spark, large, monkeypatch, tmp_path):
    """Sums are grouped where their file is written; a cube with more rows has more files."""
    from bazaarcube.plans.cubes import CUBES, build_cube
    from bazaarcube.plans.lattice import lattice_columns, spec_gid
    from bazaarcube.streaming import cube_stream

    specs = [CUBES[n] for n in ("cube_0d", "cube_1d_thang", "cube_2d_ma_kh_ma_mh")]
    fact, path, target = large["Fact_DonDatHang"], str(tmp_path / "sums"), str(tmp_path / "compacted")
    for batch in (0, 1):
        cube_stream.write_batch(large, fact.filter(F.col("maDon") % 2 == batch), specs, path, batch)
    monkeypatch.setattr(cube_stream, "FILE_ROWS", 2000, raising=False)
    rebalanced, frame = [], type(fact)
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, name, *a: rebalanced.append(name) or hint(df, name, *a))
    cube_stream.compact(large, path, target, specs)
    assert not rebalanced
    files = {s.name: len(glob.glob(f"{target}/*/*/gid={spec_gid(s, lattice_columns(specs))}/*.parquet")) for s in specs}
    assert files["cube_0d"] == files["cube_1d_thang"] == 1 and files["cube_2d_ma_kh_ma_mh"] > 1  # buckets may share a task
    for spec in specs:
        got, want = (sorted(x.collect(), key=str) for x in (cube_stream.read_cube(large, target, spec, specs), build_cube(large, spec)))
        assert got == want
