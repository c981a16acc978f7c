from __future__ import annotations

from pyspark.sql import functions as F

from bazaarcube.plans import lattice
from bazaarcube.plans.cubes import specs_for
from bazaarcube.streaming import cube_stream


def test_partial_sums_are_written_where_they_were_grouped(spark, edge_star, monkeypatch, tmp_path):
    """No sum is shuffled a second time on its way to the files of its cube."""
    seen, plain = [], cube_stream.lattice
    monkeypatch.setattr(cube_stream, "lattice", lambda *a: seen.append(plain(*a)) or Watched(seen[-1], seen))

    class Watched:
        def __init__(self, df, log):
            self.df, self.log = df, log

        def __getattr__(self, name):
            self.log.append(name)
            return getattr(self.df, name)

    specs = specs_for("inventory", (0, 1))
    cube_stream.write_batch(edge_star, edge_star["Fact_TonKho"], specs, str(tmp_path / "sums"), 0)
    assert seen[1:] == ["write"]
    cells = spark.read.parquet(str(tmp_path / "sums"))
    total = edge_star["Fact_TonKho"].agg(F.sum("soLuongTonKho")).first()[0]
    gid = lattice.spec_gid(specs[0], lattice.lattice_columns(specs))
    assert cells.filter(F.col("gid") == gid).first()["tongTonKho"] == total
