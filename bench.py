"""Headline timings at one scale; prints one JSON line.

Every query runs to the end into Spark's no-op sink. ``star_build`` is the whole
transform and load, single cubes come straight from their fact, and
``cubes_78_stored`` writes all cubes from the shared key cells.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from bazaarcube.plans import olap, reports  # noqa: E402
from bazaarcube.plans.cubes import CUBES, build_cube, specs_for  # noqa: E402
from bazaarcube.plans.lattice import build_cubes, build_lattice  # noqa: E402
from bazaarcube.plans.star import build_star  # noqa: E402
from bazaarcube.session import build_session, new_folder  # noqa: E402
from bazaarcube.sources.testdata import sources_from_testdata  # noqa: E402
from bazaarcube.streaming.cube_stream import read_cube, write_batch  # noqa: E402


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object]) -> object:
        start = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    raw = sources_from_testdata(spark, sf_dir)
    star = timed("star_build", lambda: build_star(spark, raw, new_folder(spark, "star")))

    for name in (
        "cube_0d", "cube_2d_nam_bang", "cube_2d_ma_kh_ma_mh", "cube_3d_thang_ma_kh_ma_mh",
        "cube_3d_thang_ma_mh_thanhpho", "inv_cube_2d_thang_thanhpho", "inv_cube_3d_store_product_time",
    ):
        timed(name, lambda: run_all(build_cube(star, CUBES[name])))
    stored = new_folder(spark, "cubes")
    timed("cubes_78_stored", lambda: [build_cubes(star, stored, s) for s in ("order", "inventory")])
    timed("lattice_order", lambda: run_all(build_lattice(star, "order")))
    timed("lattice_inventory", lambda: run_all(build_lattice(star, "inventory")))

    specs = specs_for("order")
    partials = new_folder(spark, "partials")
    timed("incremental_batch", lambda: write_batch(star, star["Fact_DonDatHang"], specs, partials, 0))
    timed("incremental_read", lambda: run_all(read_cube(star, partials, CUBES["cube_2d_nam_bang"], specs)))

    for name, report in (
        ("report_01_revenue_by_month", reports.revenue_by_month),
        ("report_02_top_products", reports.top_products),
        ("report_03_customer_types", reports.customer_types),
        ("report_04_stock_by_store", reports.stock_by_store),
        ("report_05_products_on_sale", reports.products_on_sale),
        ("report_06_orders_per_customer", reports.orders_per_customer),
        ("report_07_stores_for_customer", lambda s: reports.stores_for_customer(s, 7)),
        ("report_08_office_stock_above", lambda s: reports.office_stock_above(s, 10, 50)),
        ("report_09_order_sourcing", reports.order_sourcing),
        ("report_12_order_detail", lambda s: reports.order_detail(s, 5)),
        ("rollup_geo", olap.rollup_geo),
        ("stock_latest_snapshot", olap.latest_stock),
    ):
        timed(name, lambda: run_all(report(star)))
    timed("recon_revenue_by_state", lambda: run_all(olap.revenue_reconciliation(raw, star)))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
