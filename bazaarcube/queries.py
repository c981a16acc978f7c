"""The registered queries: name -> function of (session, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.functions.columns import key_date, key_day, key_month, key_year, nan_to_null
from bazaarcube.operators.facts import quarantine
from bazaarcube.operators.joins import join_dim
from bazaarcube.operators.quality import foreign_key_report, insert_if_absent, primary_key_report, reconcile
from bazaarcube.operators.scd import first_version, merge_versions
from bazaarcube.plans import olap, reports
from bazaarcube.plans.cubes import CUBES, LINES, CubeSpec, build_cube, guide_specs, specs_for
from bazaarcube.plans.distinct import SetCube, add_batch, compact_sets, distinct_customers, read_sets, store_sets
from bazaarcube.plans.increment import increment_star
from bazaarcube.plans.lattice import answer_from_cube, build_cubes, build_lattice, open_cube
from bazaarcube.plans.pipeline import run_etl
from bazaarcube.plans.star import customer_view, star_for_testdata, store_view, with_day_names
from bazaarcube.session import new_folder, stage
from bazaarcube.sinks.runlog import read_runs
from bazaarcube.sinks.warehouse import Star, row_counts
from bazaarcube.sources.operational import Tables, extract, table_counts
from bazaarcube.sources.testdata import sources_from_testdata
from bazaarcube.streaming.cube_stream import backfill, compact, fact_stream, read_cube, start_cube_stream, write_batch
from bazaarcube.streaming.stock_stream import start_stock_stream

Query = Callable[[SparkSession, str], DataFrame]

#: Bytes of new fact files that one micro-batch takes.
BATCH_BYTES = 256 << 20

# Parameters of the reports that ask for one customer, product, city or order.
CUSTOMER, PRODUCT, THRESHOLD, CITY, ORDER = 7, 10, 50, "NATION_16", 5


def _on_star(make: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(star_for_testdata(spark, sf_dir))


def _on_sources(make: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(sources_from_testdata(spark, sf_dir))


def _as_double(df: DataFrame, *money: str) -> DataFrame:
    """Exact money becomes DOUBLE only where a result leaves the library."""
    return df.withColumns({name: F.col(name).cast("double") for name in money})


def _as_text(df: DataFrame, *keys: str) -> DataFrame:
    """Integer keys as text where a row may leave them out, so that a missing key
    does not depend on how a client shows a missing integer."""
    return df.withColumns({name: F.col(name).cast("string") for name in keys if name in df.columns})


def _extracted(name: str) -> Query:
    def make(raw: Tables) -> DataFrame:
        df = extract(raw)[name]
        return _as_double(df, "giadat") if "giadat" in df.columns else df

    return _on_sources(make)


def _table(name: str) -> Query:
    def make(star: Star) -> DataFrame:
        df = star[name]
        return _as_double(df, "giaDat", "thanhTien") if name == "Fact_DonDatHang" else df

    return _on_star(make)


def _time_key_parts(star: Star) -> DataFrame:
    key = F.col("sk_thoiGian")
    return star["Fact_DonDatHang"].select(
        "maDon",
        "sk_thoiGian",
        key_date(key).alias("ngay"),
        key_year(key).alias("nam"),
        key_month(key).alias("thang"),
        key_day(key).alias("ngay_trong_thang"),
    )


def _insert_order_lines(raw: Tables) -> DataFrame:
    """All order lines offered to an empty table: one line per key is kept."""
    lines = raw["mathang_duocdat"].select("mathangmamh", "dondathangmadon", "soluongdat")
    empty = lines.sparkSession.createDataFrame([], lines.schema)
    return insert_if_absent(empty, lines, ("mathangmamh", "dondathangmadon"))


def _nan_to_null(raw: Tables) -> DataFrame:
    """Products whose weight is NaN in every seventh row, with NaN as NULL."""
    weight = F.when(F.col("mamh") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("gia").cast("double"))
    return nan_to_null(raw["mathang"].select("mamh", weight.alias("trongluong")))


def _quarantined(star: Star) -> DataFrame:
    """Order lines whose customer (every tenth key) or product (every ninth) is unknown."""
    fact = star["Fact_DonDatHang"]
    for key, step in (("sk_khachHang", 10), ("sk_matHang", 9)):
        fact = fact.withColumn(key, F.when(F.col(key) % step != 0, F.col(key)))
    found = quarantine(fact, ["sk_thoiGian", "sk_khachHang", "sk_matHang"])
    return found.groupBy("lyDo").agg(F.count("*").alias("soDong"), F.sum("soLuongDat").alias("soLuong"))


def _logged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from the sources to the stored star, as its log shows it."""
    warehouse = new_folder(spark, "dw")
    run_etl(spark, sources_from_testdata(spark, sf_dir), warehouse)
    return read_runs(spark, f"{warehouse}/pipeline_runs").select("job_name", "status", "records_extracted", "records_loaded")


def _insert_overlap(raw: Tables) -> DataFrame:
    """Lines of two thirds of the orders are there already; lines of another two thirds
    arrive with other quantities. Where both have a key the existing line stays."""
    lines = raw["mathang_duocdat"].select("mathangmamh", "dondathangmadon", "soluongdat", "giadat")
    third = F.col("dondathangmadon") % 3
    arriving = lines.filter(third != 1).withColumn("soluongdat", F.col("soluongdat") + 1000)
    merged = insert_if_absent(lines.filter(third != 0), arriving, ("mathangmamh", "dondathangmadon"))
    return _as_double(merged, "giadat")


def _recon_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of the source against those of a warehouse where every thousandth order
    has other quantities, some orders are missing and some lines are there twice."""
    star, lines = star_for_testdata(spark, sf_dir), sources_from_testdata(spark, sf_dir)["mathang_duocdat"]
    order, product = F.col("maDon").cast("bigint"), F.col("maMH").cast("bigint")
    price = F.col("giaDat").cast("decimal(18,2)").alias("giaDat")
    source = lines.toDF(*[c.lower() for c in lines.columns]).select(
        F.col("dondathangmadon").cast("string").alias("maDon"), F.col("mathangmamh").cast("string").alias("maMH"),
        F.col("soluongdat").alias("soLuongDat"), F.col("giadat").alias("giaDat"),
    ).select("maDon", "maMH", "soLuongDat", price)
    stored = join_dim(star["Fact_DonDatHang"], star["Dim_MatHang"].select("sk_matHang", F.col("maMH")), "sk_matHang", "inner", star.rows["Dim_MatHang"])
    stored = stored.select(F.col("maDon").cast("string").alias("maDon"), F.col("maMH").cast("string").alias("maMH"), "soLuongDat", price)
    off = stored.withColumn("soLuongDat", F.when(order % 1000 == 0, F.col("soLuongDat") + 1).otherwise(F.col("soLuongDat")))
    kept = off.filter(order % 777 != 0)
    twice = kept.unionByName(kept.filter((order % 501 == 0) & (product % 2 == 0)))
    return _as_double(reconcile(source, twice, ("maDon", "maMH")), "giaDat")


def _first_load(raw: Tables) -> Tables:
    """What a first load knows: most products and customers, two thirds of the orders
    (some of unknown customers or products), two thirds of the stock records."""
    customers = {t: raw[t].filter(F.col(c) % 7 != 3) for t, c in (("khachhang", "makh"), ("khachhang_dulich", "khachhangmakh"), ("khachhang_buudien", "khachhangmakh"))}
    return {
        **raw,
        **customers,
        "mathang": raw["mathang"].filter(F.col("mamh") % 5 != 2),
        "dondathang": raw["dondathang"].filter(F.col("madon") % 3 != 1),
        "mathang_duocdat": raw["mathang_duocdat"].filter(F.col("dondathangmadon") % 3 != 1),
        "mathang_duoctru": raw["mathang_duoctru"].filter((F.col("soluongtrongkho") % 3 != 0) & (F.col("mathangmamh") % 5 != 2)),
    }


def _two_loads(make: Callable[[Star], DataFrame]) -> Query:
    """A first load, then all source rows as a second one that adds what is new."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, warehouse = sources_from_testdata(spark, sf_dir), new_folder(spark, "grown")
        increment_star(spark, _first_load(raw), warehouse)
        return make(increment_star(spark, raw, warehouse))

    return run


def _members(star: Star) -> DataFrame:
    ids = {"Dim_MatHang": "maMH", "Dim_DiaDiem": "maTP", "Dim_KhachHang": "maKH", "Dim_CuaHang": "maCH"}
    keys = {"Dim_MatHang": "sk_matHang", "Dim_DiaDiem": "sk_diaDiem", "Dim_KhachHang": "sk_khachHang", "Dim_CuaHang": "sk_cuaHang"}
    parts = [star[t].select(F.lit(t).alias("bang"), F.col(c).cast("string").alias("ma"), F.col(keys[t]).alias("khoa")) for t, c in ids.items()]
    return reduce(DataFrame.union, parts)


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill, two batches, a compaction of the first, and both batches replayed."""
    star = star_for_testdata(spark, sf_dir)
    specs = specs_for("order", (0, 1, 2))
    fact = star["Fact_DonDatHang"]
    part = F.pmod(F.xxhash64("maDon"), F.lit(3))
    before = Star({**star.tables, "Fact_DonDatHang": fact.filter(part == 0)}, star.rows)
    path, target = new_folder(spark, "partials"), new_folder(spark, "compacted")
    backfill(before, specs, path)
    for batch in (0, 1):
        write_batch(star, fact.filter(part == batch + 1), specs, path, batch)
    compact(star, path, target, specs, committed=0)
    for batch in (0, 1):
        write_batch(star, fact.filter(part == batch + 1), specs, target, batch)
    return read_cube(star, target, CUBES["cube_2d_quy_thanhpho"], specs)


def _incremental(subject: str, cube: str, family: Callable[[str], list[CubeSpec]] = specs_for) -> Query:
    """Stream the stored fact, so many bytes at a time, into the partial sums of all
    cubes of a family, then read one cube."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = star_for_testdata(spark, sf_dir)
        specs = family(subject)
        landing = new_folder(spark, "landing")
        fact = {"order": "Fact_DonDatHang", "inventory": "Fact_TonKho"}[subject]
        star[fact].write.parquet(landing)
        target = new_folder(spark, "partials")
        facts = fact_stream(spark, star, subject, landing, bytes_per_batch=BATCH_BYTES)
        query = start_cube_stream(
            star, facts, specs, target, new_folder(spark, "progress"), available_now=True
        )
        query.awaitTermination()
        return read_cube(star, target, CUBES[cube], specs)

    return run


def _corrected_stock(spark: SparkSession, sf_dir: str, cube: str = "inv_cube_2d_thang_thanhpho", days: bool = False) -> DataFrame:
    """Every third stock record is first entered too low and corrected in a later batch;
    records of one day arrive in different batches."""
    star = star_for_testdata(spark, sf_dir)
    specs = guide_specs("inventory") if days else specs_for("inventory")
    records = sources_from_testdata(spark, sf_dir)["mathang_duoctru"]
    landing = new_folder(spark, "records")
    third = (F.col("mathangmamh") + F.col("cuahangmach")) % 3 == 0
    low = records.filter(third).withColumn("soluongtrongkho", F.floor(F.col("soluongtrongkho") / 2).cast("int"))
    odd = F.col("soluongtrongkho") % 2 == 1
    path, state, progress = new_folder(spark, "partials"), new_folder(spark, "closes"), new_folder(spark, "progress")
    for part in (low.unionByName(records.filter(~third & odd)), records.filter(third | ~odd)):
        part.write.mode("append").parquet(landing)  # what a run of the stream finds is one batch here
        facts = spark.readStream.schema(records.schema).parquet(landing)
        start_stock_stream(star, facts, specs, path, state, progress, available_now=True).awaitTermination()
    return read_cube(star, path, CUBES[cube], specs)


def _stored(subject: str, cube: str) -> Query:
    """One cube out of the stored cubes by day, store and line count."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star, path = star_for_testdata(spark, sf_dir), new_folder(spark, "cubes")
        build_cubes(star, path, subject, dims=(), more=guide_specs(subject))
        return open_cube(spark, path, CUBES[cube])

    return run


def _lines_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and lines by day, answered from the stored cube by day."""
    star, path = star_for_testdata(spark, sf_dir), new_folder(spark, "cubes")
    names = build_cubes(star, path, "order", dims=(1,), more=guide_specs("order"))
    rows = {name: spark.read.parquet(f"{path}/{name}").count() for name in names}
    return answer_from_cube(spark, path, "order", ["ngay"], rows, (LINES,))[1]


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by customer type, answered from the smallest stored cube."""
    star = star_for_testdata(spark, sf_dir)
    path = new_folder(spark, "cubes")
    names = build_cubes(star, path, "order", dims=(1, 2))
    rows = {name: spark.read.parquet(f"{path}/{name}").count() for name in names}
    return answer_from_cube(spark, path, "order", ["loaiKhachHang"], rows)[1]


def _from_cubes(group: list[str], where: dict[str, object], subject: str = "order") -> Query:
    """A filtered question answered from the smallest stored cube that can tell."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star, path = star_for_testdata(spark, sf_dir), new_folder(spark, "cubes")
        names = build_cubes(star, path, subject, dims=(1, 2))
        rows = {name: spark.read.parquet(f"{path}/{name}").count() for name in names}
        cube, found = olap.answer(star, path, subject, group, where, rows)
        if cube is None:
            raise LookupError("meant to be answered from a cube")
        return found

    return run


#: The columns of the stored set cube.
SETS = SetCube(("nam", "quy", "thang", "loaiKhachHang", "mien", "tenThanhPho"))


def _on_sets(make: Callable[[DataFrame], DataFrame]) -> Query:
    """A set cube of half of the orders, a batch, a compaction, another batch, and the
    first batch once more; customers occur in all of them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star, path = star_for_testdata(spark, sf_dir), new_folder(spark, "sets")
        fact = star["Fact_DonDatHang"]
        part = F.pmod(F.xxhash64("maDon"), F.lit(4))
        store_sets(Star({**star.tables, "Fact_DonDatHang": fact.filter(part > 1)}, star.rows), SETS, path)
        add_batch(star, SETS, fact.filter(part == 0), path, 0)
        compact_sets(spark, SETS, path, committed=0)
        for batch in (1, 0):
            add_batch(star, SETS, fact.filter(part == batch), path, batch)
        return make(read_sets(spark, path))

    return run


def _scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the customers: those known at the end of 1995 (registered
    in a subtype, or with an order), and all at the end of 2001."""
    raw = sources_from_testdata(spark, sf_dir)
    first, second = "1995-12-31", "2001-12-31"
    now = raw["khachhang"].select(
        F.col("makh").alias("maKH"), F.col("tenkh").alias("tenKH"), F.col("ngaydatdautien").alias("ngayDatHangDauTien")
    )
    registered = (
        raw["khachhang_dulich"].select("khachhangmakh")
        .union(raw["khachhang_buudien"].select("khachhangmakh"))
        .distinct()
        .select(F.col("khachhangmakh").alias("maKH"), F.lit(True).alias("dangKy"))
    )
    ordered = F.col("ngayDatHangDauTien") <= F.lit(first).cast("date")
    before = (
        now.join(registered, "maKH", "left")
        .filter(F.coalesce("dangKy", F.lit(False)) | F.coalesce(ordered, F.lit(False)))
        .select("maKH", "tenKH", F.when(ordered, F.col("ngayDatHangDauTien")).alias("ngayDatHangDauTien"))
    )
    dim = stage(first_version(before, "maKH", "sk_khachHang", first), "scd")
    return merge_versions(dim, now, "maKH", "sk_khachHang", second)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, spec in CUBES.items():
        found[name] = _on_star(lambda star, spec=spec: build_cube(star, spec))
    for name in (
        "vanphongdaidien", "mathang", "khachhang", "khachhang_dulich", "khachhang_buudien", "cuahang",
        "mathang_duoctru", "dondathang", "mathang_duocdat",
    ):
        found[f"extract_{name}"] = _extracted(name)
    found["recon_order_lines"] = _recon_lines
    found["nan_to_null_products"] = _on_sources(_nan_to_null)
    found["quarantined_order_lines"] = _on_star(_quarantined)
    found["logged_run"] = _logged_run
    found["drilldown_stores_in_city"] = _on_star(lambda s: olap.drill_to_stores(s, CITY))
    found["slice_customer"] = _on_star(lambda s: olap.slice_customer(s, CUSTOMER))
    found["slice_product"] = _on_star(lambda s: olap.slice_product(s, PRODUCT))
    found["slice_city"] = _on_star(lambda s: olap.slice_city(s, CITY))
    found["insert_if_absent_overlap"] = _on_sources(_insert_overlap)
    found["cube_backfill_stream_compact"] = _compacted
    found["extract_counts"] = _on_sources(lambda raw: table_counts(extract(raw)))
    for name in (
        "Dim_ThoiGian", "Dim_MatHang", "Dim_DiaDiem", "Dim_KhachHang", "Dim_CuaHang", "Fact_DonDatHang",
        "Fact_TonKho",
    ):
        found[name.lower()] = _table(name)
    found["dim_cuahang_denorm"] = _on_star(store_view)
    found["dim_khachhang_denorm"] = _on_star(customer_view)
    found["calendar_day_names"] = _on_star(lambda star: with_day_names(star["Dim_ThoiGian"]))
    found["time_key_parts"] = _on_star(_time_key_parts)
    found["row_counts"] = _on_star(row_counts)

    found["dq_duplicate_keys"] = _on_sources(primary_key_report)
    found["dq_orphans"] = _on_sources(foreign_key_report)
    found["insert_if_absent_order_lines"] = _on_sources(_insert_order_lines)
    found["recon_revenue_by_state"] = lambda spark, sf_dir: olap.revenue_reconciliation(
        sources_from_testdata(spark, sf_dir), star_for_testdata(spark, sf_dir)
    )

    found["report_01_revenue_by_month"] = _on_star(reports.revenue_by_month)
    found["report_02_top_products"] = _on_star(reports.top_products)
    found["report_03_customer_types"] = _on_star(reports.customer_types)
    found["report_03_customer_types_stored"] = _on_sets(lambda cells: reports.customer_types_stored(cells, SETS))
    found["distinct_customers_by_quarter_region"] = _on_sets(
        lambda cells: distinct_customers(cells, SETS, ("nam", "quy", "mien"))
    )
    found["preview_products"] = _on_star(lambda star: reports.preview(star, "Dim_MatHang"))
    found["report_04_stock_by_store"] = _on_star(reports.stock_by_store)
    found["report_05_products_on_sale"] = _on_star(reports.products_on_sale)
    found["report_06_orders_per_customer"] = _on_star(reports.orders_per_customer)
    found["report_06_orders_per_customer_distinct"] = _on_star(
        lambda star: reports.orders_per_customer(star, distinct=True)
    )
    found["report_07_stores_for_customer"] = _on_star(lambda s: reports.stores_for_customer(s, CUSTOMER))
    found["report_08_office_stock_above"] = _on_star(
        lambda s: reports.office_stock_above(s, PRODUCT, THRESHOLD)
    )
    found["report_09_order_sourcing"] = _on_star(reports.order_sourcing)
    found["report_09_order_sourcing_sets"] = _on_star(reports.sourcing_sets)
    found["report_09_order_sourcing_one"] = _on_star(lambda s: reports.unfolded(reports.sourcing_sets(s), ORDER))
    found["report_10_customer_place"] = _on_star(lambda s: reports.customer_place(s, CUSTOMER))
    found["report_11_stock_in_city"] = _on_star(lambda s: reports.stock_in_city(s, PRODUCT, CITY))
    found["report_12_order_detail"] = _on_star(lambda s: reports.order_detail(s, ORDER))
    found["report_13_customer_groups"] = _on_star(reports.customer_groups)
    found["customers_both_intersect"] = _on_sources(reports.customers_both)
    found["customers_travel_only_except"] = _on_sources(reports.customers_travel_only)
    found["customers_postal_only_except"] = _on_sources(reports.customers_postal_only)

    found["rollup_geo"] = _on_star(lambda star: _as_text(olap.rollup_geo(star), "maCH"))
    found["drilldown_month_in_state"] = _on_star(lambda s: olap.drill_down(s, "ASIA"))
    found["slice_customer_type"] = _on_star(lambda s: olap.slice_cube(s, "Du lich"))
    found["dice_type_city_month"] = _on_star(lambda s: olap.dice_cube(s, PRODUCT, CITY, 3))
    found["slice_city_stored"] = _from_cubes(["nam", "thang", "tenThanhPho"], {"tenThanhPho": CITY})
    found["drilldown_month_in_state_stored"] = _from_cubes(["mien", "tenThanhPho", "nam", "thang"], {"mien": "ASIA"})
    found["rollup_quarter_of_regions_stored"] = _from_cubes(["nam", "quy"], {"mien": ["ASIA", "EUROPE"]}, "inventory")
    found["stock_latest_snapshot"] = _on_star(olap.latest_stock)

    keys = ("nam", "quy", "thang", "maKH", "maMH")
    found["lattice_order"] = _on_star(lambda star: _as_text(build_lattice(star, "order"), *keys))
    found["lattice_inventory"] = _on_star(lambda star: _as_text(build_lattice(star, "inventory"), *keys))
    found["cube_incremental"] = _incremental("order", "cube_2d_quy_thanhpho")
    found["cube_incremental_inventory"] = _incremental("inventory", "inv_cube_2d_thang_thanhpho")
    found["cube_resolved"] = _resolved
    found["inventory_corrected_stream"] = _corrected_stock
    found["inventory_corrected_stream_day"] = lambda spark, sf_dir: _corrected_stock(spark, sf_dir, "inv_cube_2d_store_time", True)
    found["cube_incremental_day"] = _incremental("order", "cube_1d_time", guide_specs)
    found["cube_2d_product_time_stored"] = _stored("order", "cube_2d_product_time")
    found["inv_cube_3d_store_product_time_stored"] = _stored("inventory", "inv_cube_3d_store_product_time")
    found["cube_resolved_day"] = _lines_by_day
    found["incremental_star"] = _two_loads(lambda star: _as_double(star["Fact_DonDatHang"], "giaDat", "thanhTien"))
    found["incremental_star_stock"] = _two_loads(lambda star: star["Fact_TonKho"])
    found["incremental_star_members"] = _two_loads(_members)
    found["scd2_customer"] = _scd2
    return found
