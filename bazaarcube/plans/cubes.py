"""The cubes: 60 over orders, 18 over stock, and the documented daily ones.

A cube is a set of grouping columns over one subject. The grouping columns say
which surrogate keys of the fact are needed (its *key axes*): a cube by region
needs the customer key, since an order is located at the customer's office.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarcube.operators.joins import fits_broadcast, join_dim, join_packed
from bazaarcube.sinks.warehouse import Star


@dataclass(frozen=True)
class Measure:
    """A sum with its stored (exact) and its reported type; a NULL source counts rows."""

    name: str
    source: str | None
    exact: str
    reported: str

    def sum_of(self, merged: bool) -> Column:
        return self.merged_sum() if merged else self.first_sum()

    def first_sum(self) -> Column:
        counted = F.count(F.lit(1)) if self.source is None else F.sum(self.source)
        return counted.cast(self.exact).alias(self.name)

    def merged_sum(self) -> Column:
        return F.sum(self.name).cast(self.exact).alias(self.name)

    def report(self) -> Column:
        return F.col(self.name).cast(self.reported).alias(self.name)


@dataclass(frozen=True)
class Subject:
    """What a family of cubes measures, and where its rows are located."""

    fact: str
    measures: tuple[Measure, ...]
    place_key: str  # the dimension key through which a row gets its office
    # the dimension keys, with the dimension table and labels each one gives
    labels: dict[str, tuple[str, tuple[str, ...]]]

    @property
    def keys(self) -> tuple[str, ...]:
        return tuple(self.labels)


REVENUE = Measure("tongDoanhThu", "thanhTien", "decimal(38,2)", "double")
QUANTITY = Measure("tongSoLuong", "soLuongDat", "bigint", "bigint")
LINES = Measure("soLanDat", None, "bigint", "bigint")
STOCK = Measure("tongTonKho", "soLuongTonKho", "bigint", "bigint")

TIME_COLUMNS = ("nam", "quy", "thang", "ngay")
PLACE_COLUMNS = ("mien", "tenThanhPho")
PLACED = "_placed"

SUBJECTS: dict[str, Subject] = {
    "order": Subject(
        "Fact_DonDatHang",
        (REVENUE, QUANTITY),
        "sk_khachHang",
        {
            "sk_khachHang": ("Dim_KhachHang", ("maKH", "loaiKhachHang")),
            "sk_matHang": ("Dim_MatHang", ("maMH", "tenMH")),
        },
    ),
    "inventory": Subject(
        "Fact_TonKho",
        (STOCK,),
        "sk_cuaHang",
        {
            "sk_cuaHang": ("Dim_CuaHang", ("maCH",)),
            "sk_matHang": ("Dim_MatHang", ("maMH",)),
        },
    ),
}


def keys_of(subject: str, group: Sequence[str]) -> tuple[str, ...]:
    """The dimension keys whose labels the grouping columns come from."""
    what = SUBJECTS[subject]
    placed = any(c in PLACE_COLUMNS for c in group)
    return tuple(
        key
        for key, (_, labels) in what.labels.items()
        if any(c in labels for c in group) or (placed and key == what.place_key)
    )


@dataclass(frozen=True)
class CubeSpec:
    name: str
    subject: str
    group: tuple[str, ...]
    dims: int
    extra: tuple[Measure, ...] = ()

    @property
    def measures(self) -> tuple[Measure, ...]:
        return SUBJECTS[self.subject].measures + self.extra

    @property
    def time(self) -> tuple[str, ...]:
        return tuple(c for c in self.group if c in TIME_COLUMNS)

    @property
    def axes(self) -> frozenset[str]:
        """Needed key axes; ``T`` stands for the calendar, ``D`` for its days."""
        days = {"D"} if "ngay" in self.group else frozenset()
        return frozenset(keys_of(self.subject, self.group)) | ({"T"} if self.time else frozenset()) | days

    @property
    def columns(self) -> list[str]:
        return [*self.group, *[m.name for m in self.measures]]


_TIME = {"": (), "nam": ("nam",), "quy": ("nam", "quy"), "thang": ("nam", "thang")}


def _named(prefix: str, parts: Iterable[str]) -> tuple[str, int]:
    used = [p for p in parts if p]
    return "_".join([f"{prefix}_{len(used)}d", *used]), len(used)


def _order_specs() -> list[CubeSpec]:
    """Cells of time x customer x product x location with at most three axes."""
    places = {"": (), "bang": ("mien",), "thanhpho": ("mien", "tenThanhPho")}
    specs = []
    for time, customer, item, place in product(_TIME, ("", "loai_kh", "ma_kh"), ("", "ma_mh"), places):
        name, dims = _named("cube", (time, customer, item, place))
        if dims > 3:
            continue
        group = list(_TIME[time])
        if customer == "loai_kh":
            group.append("loaiKhachHang")
        elif customer == "ma_kh":
            group.append("maKH")
            # The type goes with the id alone, and with the id by year.
            if not item and not place and time in ("", "nam"):
                group.append("loaiKhachHang")
        if item:
            group.append("maMH")
            # The name goes with the product everywhere but in the 1-D cube.
            if dims > 1:
                group.append("tenMH")
        specs.append(CubeSpec(name, "order", (*group, *places[place]), dims))
    return specs


def _inventory_specs() -> list[CubeSpec]:
    """Cells of time x product x location with at most two axes. A city stands
    alone here, without its region."""
    places = {"": (), "bang": ("mien",), "thanhpho": ("tenThanhPho",)}
    specs = []
    for time, item, place in product(_TIME, ("", "mathang"), places):
        name, dims = _named("inv_cube", (time, item, place))
        if dims <= 2:
            group = (*_TIME[time], *(("maMH",) if item else ()), *places[place])
            specs.append(CubeSpec(name, "inventory", group, dims))
    return specs


def _guide_specs() -> list[CubeSpec]:
    """The cubes described, but not built, by the guide: a day level, a line
    count, and (for stock, which has a store) a store axis."""
    return [
        CubeSpec("cube_1d_product", "order", ("maMH",), 1, (LINES,)),
        CubeSpec("cube_1d_time", "order", ("ngay",), 1, (LINES,)),
        CubeSpec("cube_2d_product_time", "order", ("maMH", "ngay"), 2, (LINES,)),
        CubeSpec("inv_cube_1d_store", "inventory", ("maCH",), 1),
        CubeSpec("inv_cube_2d_store_product", "inventory", ("maCH", "maMH"), 2),
        CubeSpec("inv_cube_2d_store_time", "inventory", ("maCH", "ngay"), 2),
        CubeSpec("inv_cube_3d_store_product_time", "inventory", ("maCH", "maMH", "ngay"), 3),
    ]


ORDER_CUBES: tuple[CubeSpec, ...] = tuple(_order_specs())
INVENTORY_CUBES: tuple[CubeSpec, ...] = tuple(_inventory_specs())
GUIDE_CUBES: tuple[CubeSpec, ...] = tuple(_guide_specs())
CUBES: dict[str, CubeSpec] = {s.name: s for s in (*ORDER_CUBES, *INVENTORY_CUBES, *GUIDE_CUBES)}


def measures_of(specs: Sequence[CubeSpec]) -> tuple[Measure, ...]:
    """The measures of the subject, and what some of ``specs`` count beside them."""
    return tuple(dict.fromkeys((*SUBJECTS[specs[0].subject].measures, *(m for s in specs for m in s.extra))))


def guide_specs(subject: str) -> list[CubeSpec]:
    return [s for s in GUIDE_CUBES if s.subject == subject]


def specs_for(subject: str, dims: Iterable[int] = (0, 1, 2, 3)) -> list[CubeSpec]:
    wanted = set(dims)
    family = ORDER_CUBES if subject == "order" else INVENTORY_CUBES
    return [s for s in family if s.dims in wanted]


# --- building ----------------------------------------------------------------


def with_calendar(star: Star, fact: DataFrame, columns: Iterable[str], how: str = "inner") -> DataFrame:
    """Add calendar columns. A calendar holds one short row per day of the data,
    at most the days of the DATE range, so broadcasting it is bounded."""
    calendar = star["Dim_ThoiGian"].select("sk_thoiGian", *columns)
    return fact.join(F.broadcast(calendar), "sk_thoiGian", how)


def label_table(
    star: Star, subject: str, key: str, columns: Iterable[str], keep_unplaced: bool = False
) -> DataFrame:
    """The dimension behind ``key`` with the wanted labels, places included.

    A cube by place has no rows for customers or stores without a known office.
    With ``keep_unplaced`` they stay, and ``PLACED`` tells them apart.
    """
    table, _ = SUBJECTS[subject].labels[key]
    dim = star[table]
    wanted = list(columns)
    if any(c in PLACE_COLUMNS for c in wanted):
        offices = star["Dim_DiaDiem"].select("sk_diaDiem", *PLACE_COLUMNS, F.lit(True).alias(PLACED))
        small = fits_broadcast(offices, star.rows["Dim_DiaDiem"])
        how = "left" if keep_unplaced else "inner"
        dim = dim.join(F.broadcast(offices) if small else offices, "sk_diaDiem", how)
        if keep_unplaced:
            dim = dim.withColumn(PLACED, F.coalesce(PLACED, F.lit(False)))
            wanted.append(PLACED)
    return dim.select(key, *wanted)


def labels_of(subject: str, key: str, group: Sequence[str]) -> list[str]:
    """The columns of ``group`` that ``key`` determines."""
    what = SUBJECTS[subject]
    places = PLACE_COLUMNS if key == what.place_key else ()
    return [c for c in group if c in (*what.labels[key][1], *places)]


def labelled(
    star: Star,
    cell: DataFrame,
    subject: str,
    group: Sequence[str],
    merged: bool,
    keep_unplaced: bool = False,
    late: Sequence[str] = (),
) -> tuple[DataFrame, bool]:
    """``cell`` with the label columns of ``group``, and whether it holds sums.

    ``cell`` has the time columns and dimension keys that ``group`` needs, and
    either the fact's measures or (``merged``) sums made before. The keys in
    ``late`` stay as they are.

    Small dimensions are broadcast, and so are the labels of larger ones where few
    different ones are wanted (packed by key). Any other dimension would
    mean shuffling the rows by its key, hot keys included. So rows are first
    summed per key, which combines map-side and leaves one row per key value,
    and only those sums meet the dimension. They are summed again before the
    next such dimension, whose hot keys the first one's labels have thinned out.
    """
    what = SUBJECTS[subject]
    large = []
    for key in keys_of(subject, group):
        if key in late:
            continue
        table, _ = what.labels[key]
        lookup = label_table(star, subject, key, labels_of(subject, key, group), keep_unplaced)
        if fits_broadcast(lookup, star.rows[table]):
            cell = cell.join(F.broadcast(lookup), key, "inner")
        elif what.labels[key][1][0] not in lookup.columns and (packed := star.packed(lookup, table, key)):
            cell = join_packed(cell, packed, key)
        else:
            large.append((key, lookup))
    measures = (*what.measures, LINES)
    for i, (key, lookup) in enumerate(large):
        waiting = [k for k, _ in large[i:]]
        if not merged or i > 0:
            known = [c for c in (*group, PLACED) if c in cell.columns]
            present = [m for m in measures if not merged or m.name in cell.columns]
            cell = cell.groupBy(*known, *waiting, *late).agg(*[m.sum_of(merged) for m in present])
            merged = True
        cell = cell.join(lookup, key, "inner")
    return cell, merged


def late_keys(star: Star, subject: str, group: Sequence[str]) -> list[str]:
    """Dimension keys that can stand for their labels while grouping: the group
    has the dimension's id, and the stored ids are unique."""
    what = SUBJECTS[subject]
    return [
        key
        for key in keys_of(subject, group)
        if what.labels[key][1][0] in group and star.is_unique(what.labels[key][0], what.labels[key][1][0])
    ]


def group_cell(star: Star, cell: DataFrame, spec: CubeSpec, merged: bool, once: bool = False) -> DataFrame:
    """Group ``cell`` by the labels of ``spec``; the sums stay exact.

    Where the group has a dimension's id, the rows are grouped by the integer key
    and the finished groups get the labels: fewer and shorter values to shuffle. A cell
    with these groups already, each of them ``once``, is not grouped again.
    """
    late = late_keys(star, spec.subject, spec.group)
    waiting = {c for key in late for c in labels_of(spec.subject, key, spec.group)}
    early = [c for c in spec.group if c not in waiting]
    told = {*early, *late, *(("quy",) if "thang" in early else ())}  # a month tells its quarter
    by = {c for c in cell.columns if c in (*TIME_COLUMNS, *SUBJECTS[spec.subject].keys)}
    if merged and once and {*early, *late} <= by <= told:
        grouped = cell.select(*early, *late, *[m.name for m in spec.measures])
    else:
        rows, merged = labelled(star, cell, spec.subject, spec.group, merged, late=late)
        grouped = rows.groupBy(*early, *late).agg(*[m.sum_of(merged) for m in spec.measures])
    for key in late:
        table, _ = SUBJECTS[spec.subject].labels[key]
        lookup = label_table(star, spec.subject, key, labels_of(spec.subject, key, spec.group))
        grouped = join_dim(grouped, lookup, key, "inner", star.rows[table])
    return grouped.select(*spec.group, *[m.name for m in spec.measures])


def report_types(df: DataFrame, spec: CubeSpec) -> DataFrame:
    return df.select(*spec.group, *[m.report() for m in spec.measures])


def build_cube(star: Star, spec: CubeSpec) -> DataFrame:
    """One cube straight from its fact."""
    fact = star[SUBJECTS[spec.subject].fact]
    if spec.time:
        fact = with_calendar(star, fact, spec.time)
    return report_types(group_cell(star, fact, spec, merged=False), spec)
