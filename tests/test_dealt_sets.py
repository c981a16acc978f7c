from __future__ import annotations

from bazaarcube.plans import lattice
from bazaarcube.plans.cubes import QUANTITY


def test_rows_are_dealt_once_for_all_sets(spark, monkeypatch):
    """Sets with an id shuffle the rows once, not once for each set, and group as before."""
    rows = [(k % 5 if k % 7 else None, 2000 + k % 3, "a" if k % 2 else None, 1) for k in range(200)]
    base = spark.createDataFrame(rows, "ma int, nam int, loai string, soLuongDat int")
    sets, columns = [["ma", "nam", "loai"], ["ma", "nam"], ["ma", "loai"]], ["ma", "nam", "loai"]
    sums = [QUANTITY.first_sum()]
    monkeypatch.setattr(lattice, "GROUPED_ROWS", 100)
    dealt = lattice._dealt_sets(base, sets, columns, sums, 200)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(ma" in plan
    wanted = lattice._summed_sets(base, sets, columns, sums)
    assert sorted(dealt.select(*wanted.columns).collect(), key=str) == sorted(wanted.collect(), key=str)
