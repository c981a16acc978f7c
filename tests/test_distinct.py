from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarcube.plans import distinct, reports
from bazaarcube.plans.cubes import CubeSpec, build_cube
from bazaarcube.plans.distinct import SetCube
from bazaarcube.plans.star import star_for_testdata
from bazaarcube.session import new_folder
from bazaarcube.sinks.warehouse import Star
from tests.conftest import TESTDATA, values

WIDE = SetCube(("nam", "quy", "thang", "loaiKhachHang", "maMH", "tenMH", "mien", "tenThanhPho"))
GROUPS = [
    (), ("nam",), ("nam", "quy"), ("nam", "thang"), ("loaiKhachHang",), ("mien",), ("mien", "tenThanhPho"), ("maMH",),
    ("nam", "loaiKhachHang", "mien"), ("nam", "thang", "maMH", "tenThanhPho"),
]


def brute(star, group):
    """Plain distinct counts: the customer's id joins every group."""
    ids = build_cube(star, CubeSpec("ids", "order", ("maKH", *group), 0)).collect()
    found: dict[tuple, list] = {}
    for row in ids:
        cell = found.setdefault(tuple(row[c] for c in group), [set(), 0.0, 0])
        cell[0].add(row["maKH"])
        cell[1] += row["tongDoanhThu"]
        cell[2] += row["tongSoLuong"]
    if not group and not found:
        return [(0, None, None)]
    rows = [(*g, len(s), round(r, 2), n) for g, (s, r, n) in found.items()]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def rounded(df):
    return [tuple(round(v, 2) if isinstance(v, float) else v for v in row) for row in values(df)]


@pytest.mark.parametrize("group", GROUPS, ids="-".join)
def test_one_wide_set_cube_answers_every_grouping(edge_star, group):
    """Rows without a day, a customer or an office; equal city and product names."""
    cells = distinct.customer_sets(edge_star, WIDE)
    assert rounded(distinct.distinct_customers(cells, WIDE, group)) == brute(edge_star, group)


@pytest.mark.parametrize("group", [("loaiKhachHang",), ("nam", "maMH", "mien")], ids="-".join)
def test_dimensions_beyond_the_broadcast(edge_star, tiny_broadcast, group):
    cells = distinct.customer_sets(edge_star, WIDE)
    assert rounded(distinct.distinct_customers(cells, WIDE, group)) == brute(edge_star, group)


def with_customers(spark, star, keys):
    """A star whose orders come from customers with these keys, all on one day."""
    one = star["Fact_DonDatHang"].filter("maDon = 'DON002'").limit(1)
    key = spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField("sk_khachHang", T.IntegerType())]))
    fact = key.crossJoin(one.drop("sk_khachHang")).select(*star["Fact_DonDatHang"].columns)
    return Star({**star.tables, "Fact_DonDatHang": fact}, star.rows)


def test_blocks_of_keys(spark, edge_star):
    """Keys on both sides of block bounds, each ordered twice."""
    keys = [1, 2, 32767, 32768, 32769, 65535, 65536, 65537, 2**31 - 1]
    star = with_customers(spark, edge_star, keys * 2)
    cube = SetCube(("nam", "thang"))
    cells = distinct.customer_sets(star, cube)
    assert cells.count() == 4  # as many rows as blocks, in one cell
    assert [r["soKhachHang"] for r in distinct.distinct_customers(cells, cube, ("nam",)).collect()] == [len(keys)]


def test_batches_overlap_and_come_again(spark, edge_star):
    fact, path = edge_star["Fact_DonDatHang"], new_folder(spark, "sets")
    share = F.pmod(F.xxhash64("maDon", "sk_matHang"), F.lit(3))
    for batch in (1, 0, 2, 1):
        distinct.add_batch(edge_star, WIDE, fact.filter(share == batch), path, batch)
    for group in GROUPS:
        assert rounded(distinct.distinct_customers(distinct.read_sets(spark, path), WIDE, group)) == brute(edge_star, group)


def test_compaction_between_batches_of_a_live_query(spark, edge_star):
    """Batches before, while and after the parts are folded; a reader of the old parts
    goes on; folded batches that come again are skipped."""
    fact, path, landing = edge_star["Fact_DonDatHang"], new_folder(spark, "sets"), new_folder(spark, "landing")
    share = F.pmod(F.xxhash64("maDon", "sk_matHang"), F.lit(3))
    before = Star({**edge_star.tables, "Fact_DonDatHang": fact.filter(share == 0)}, edge_star.rows)
    distinct.store_sets(before, WIDE, path)
    fact.filter(share == 1).coalesce(1).write.parquet(landing)
    facts = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    query = distinct.start_set_stream(edge_star, facts, WIDE, path, new_folder(spark, "progress"), every="1 second")
    try:
        query.processAllAvailable()
        old = distinct.read_sets(spark, path)
        was = rounded(distinct.distinct_customers(old, WIDE, ("nam",)))
        distinct.compact_sets(spark, WIDE, path, committed=0)
        assert query.isActive
        assert distinct.live_parts(spark, path) == ["compacted-000000000000"]
        assert rounded(distinct.distinct_customers(old, WIDE, ("nam",))) == was
        assert rounded(distinct.distinct_customers(distinct.read_sets(spark, path), WIDE, ("nam",))) == was
        fact.filter(share == 2).coalesce(1).write.mode("append").parquet(landing)
        query.processAllAvailable()
    finally:
        query.stop()
    assert distinct.drop_folded(spark, path) == ["backfill-000000000000", "stream-000000000000"]
    distinct.add_batch(edge_star, WIDE, fact.filter(share == 1), path, 0)  # comes again
    assert rounded(distinct.distinct_customers(distinct.read_sets(spark, path), WIDE, ("nam", "quy"))) == brute(edge_star, ("nam", "quy"))


def test_estimates_stay_within_their_bound(spark, edge_star):
    """20,000 customers in four overlapping batches: within four standard errors."""
    cube = SetCube(("nam", "thang"), precision=12)
    path = new_folder(spark, "sketches")
    star = with_customers(spark, edge_star, range(1, 20001))
    fact = star["Fact_DonDatHang"].persist()
    for batch in range(4):
        distinct.add_batch(star, cube, fact.filter(F.pmod("sk_khachHang", F.lit(4)) != batch), path, batch)
    found = distinct.distinct_customers(distinct.read_sets(spark, path), cube, ("nam",)).collect()
    fact.unpersist()
    assert len(found) == 1 and abs(found[0]["soKhachHang"] - 20000) <= 4 * 1.04 / 2**6 * 20000


def test_estimated_report_on_the_tables(spark):
    star, path = star_for_testdata(spark, TESTDATA), new_folder(spark, "sketches")
    cube = SetCube(("nam", "thang", "loaiKhachHang"), precision=12)
    distinct.store_sets(star, cube, path)
    exact = {r["loaiKhachHang"]: r for r in reports.customer_types(star).collect()}
    found = reports.customer_types_stored(distinct.read_sets(spark, path), cube).collect()
    assert {r["loaiKhachHang"] for r in found} == set(exact)
    for row in found:
        true = exact[row["loaiKhachHang"]]
        assert row["tongDoanhThu"] == true["tongDoanhThu"]
        assert abs(row["soKhachHang"] - true["soKhachHang"]) <= max(1, 4 * 1.04 / 2**6 * true["soKhachHang"])


def test_no_rows_and_unknown_columns(spark, edge_star):
    cells = distinct.customer_sets(edge_star, WIDE, edge_star["Fact_DonDatHang"].limit(0))
    assert values(distinct.distinct_customers(cells, WIDE, ())) == [(0, None, None)]
    assert values(distinct.distinct_customers(cells, WIDE, ("nam",))) == []
    with pytest.raises(ValueError):
        SetCube(("maKH",))
    with pytest.raises(LookupError):
        distinct.distinct_customers(cells, SetCube(("nam",)), ("mien",))


def test_sets_are_dealt_by_their_number(spark, edge_star, monkeypatch):
    """A sparse bitmap is a few bytes in a file and 4 KB in a task, so bytes do not size tasks."""
    monkeypatch.setattr(distinct, "TASK_SETS", 2)
    monkeypatch.setattr(distinct, "TASK_ROWS", 3)
    cube, path = SetCube(("nam", "thang", "loaiKhachHang", "mien", "tenThanhPho")), new_folder(spark, "sets")
    cells = distinct.customer_sets(edge_star, cube)
    assert cells.rdd.getNumPartitions() == -(-edge_star.rows["Fact_DonDatHang"] // 3) > 1
    distinct.store_sets(edge_star, cube, path)
    distinct.add_batch(edge_star, cube, edge_star["Fact_DonDatHang"].limit(0), path, 0)
    stored = distinct.read_sets(spark, path)
    per_file = stored.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1 and max(r["count"] for r in per_file) <= 2
    assert distinct.merge_sets(stored, cube).rdd.getNumPartitions() == -(-stored.count() // 2)
    for group in ((), ("nam",), ("loaiKhachHang", "mien")):
        assert rounded(distinct.distinct_customers(stored, cube, group)) == brute(edge_star, group)
