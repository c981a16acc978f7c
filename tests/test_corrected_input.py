from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bazaarcube import queries
from bazaarcube.plans.star import build_star
from bazaarcube.session import folder_names, new_folder
from tests.conftest import source_frames


def test_batches_of_records_are_written_by_many_tasks(spark, monkeypatch):
    """The records of a batch lie in as many files as Spark writes, and are still one batch."""
    stores = [str(i) for i in range(1, 13)]
    raw = source_frames(
        spark, vanphongdaidien=[("T1", "Hue", None, "m", None)], cuahang=[(s, "0", None, "T1") for s in stores],
        mathang=[("3", "3", None, None, None, None, None)],
        mathang_duoctru=[(q, dt.date(2025, 1, 1), "3", s) for s in stores for q in (4, 5)],
    )
    for table, ids in (("cuahang", ["mach"]), ("mathang", ["mamh"]), ("mathang_duoctru", ["mathangmamh", "cuahangmach"])):
        raw[table] = raw[table].withColumns({c: F.col(c).cast("bigint") for c in ids})
    raw["mathang_duoctru"] = raw["mathang_duoctru"].repartition(4)
    star, folders, made = build_star(spark, raw, new_folder(spark, "star")), {}, new_folder
    monkeypatch.setattr(queries, "new_folder", lambda s, n: folders.setdefault(n, made(s, n)))
    monkeypatch.setattr(queries, "sources_from_testdata", lambda s, d: raw)
    monkeypatch.setattr(queries, "star_for_testdata", lambda s, d: star)
    found = queries._corrected_stock(spark, "", days=True, cube="inv_cube_1d_store").collect()
    assert sorted(map(tuple, found)) == [(int(s), 5) for s in stores]
    assert sum(n.startswith("part-") for n in folder_names(spark, folders["records"])) > 2
    assert sorted(n for n in folder_names(spark, folders["closes"]) if n.startswith("lo=")) == ["lo=0", "lo=1"]
