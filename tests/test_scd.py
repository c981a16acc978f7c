from __future__ import annotations

import random

from pyspark.sql import functions as F

from bazaarcube.operators.scd import current_versions, first_version, merge_versions
from bazaarcube.session import stage
from tests.conftest import day, values

SCHEMA = "maKH string, loai string"


def test_change_insert_keep(spark):
    dim = first_version(spark.createDataFrame([("a", "x"), ("b", None), ("c", "z")], SCHEMA), "maKH", "sk", "2025-01-01")
    new = spark.createDataFrame([("a", "x"), ("b", "y"), ("d", "w")], SCHEMA)
    merged = merge_versions(dim, new, "maKH", "sk", "2025-02-01")
    t0, t1 = day("2025-01-01"), day("2025-02-01")
    assert values(merged) == [
        (1, "a", "x", t0, None, True),
        (2, "b", None, t0, t1, False),
        (3, "c", "z", t0, None, True),
        (4, "b", "y", t1, None, True),
        (5, "d", "w", t1, None, True),
    ]


def test_same_snapshot_again_changes_nothing(spark):
    snapshot = spark.createDataFrame([("a", None), ("b", "y")], SCHEMA)
    dim = stage(first_version(snapshot, "maKH", "sk", "2025-01-01"), "dim")
    assert values(merge_versions(dim, snapshot, "maKH", "sk", "2025-02-01")) == values(dim)


def test_invariants_over_random_snapshots(spark):
    rng = random.Random(7)
    dim = None
    for month in range(1, 5):
        rows = [(f"k{i}", rng.choice("xyz")) for i in range(20) if rng.random() < 0.8]
        snapshot = spark.createDataFrame(rows, SCHEMA)
        when = f"2025-0{month}-01"
        dim = first_version(snapshot, "maKH", "sk", when) if dim is None else merge_versions(
            dim, snapshot, "maKH", "sk", when
        )
        dim = stage(dim, "dim")
        assert dim.select("sk").distinct().count() == dim.count()
        now = current_versions(dim)
        assert now.groupBy("maKH").count().filter("count > 1").isEmpty()
        assert snapshot.exceptAll(now.select("maKH", "loai")).isEmpty()
        pair = dim.alias("a").join(dim.alias("b"), F.expr("a.maKH = b.maKH AND a.sk < b.sk"))
        overlaps = pair.filter("a.hieuLucTu < coalesce(b.hieuLucDen, date'9999-01-01') "
                               "AND b.hieuLucTu < coalesce(a.hieuLucDen, date'9999-01-01')")
        assert overlaps.isEmpty()
