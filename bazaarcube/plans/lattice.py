"""Many cubes from few passes over the fact.

Sums are distributive, so a cube can be grouped from an earlier, finer sum
instead of the fact. The finer sums are kept per surrogate key: one *key cell*
for each subset of {month, first key, second key}. Eight cells serve all 60
order cubes (or all 18 stock cubes). The widest cell is one pass over the fact,
each other cell one pass over a narrower cell. Where cubes by day are wanted, a day
axis stands above the month, with cells for the keys that these cubes need; where
cubes count lines, all cells carry the count.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from itertools import combinations

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.operators.joins import fits_broadcast, join_packed
from bazaarcube.plans.cubes import (
    CUBES,
    PLACE_COLUMNS,
    PLACED,
    SUBJECTS,
    TIME_COLUMNS,
    CubeSpec,
    Measure,
    group_cell,
    label_table,
    labelled,
    labels_of,
    late_keys,
    measures_of,
    report_types,
    specs_for,
    with_calendar,
)
from bazaarcube.session import exists, move_folder, new_folder, remove_folder, stage_at
from bazaarcube.sinks.warehouse import Star

_MONTH = ("nam", "quy", "thang")
Axes = frozenset[str]


def by_day(specs: Sequence[CubeSpec]) -> bool:
    return any("D" in s.axes for s in specs)


def _time_columns(days: bool) -> tuple[str, ...]:
    return (*_MONTH, "ngay") if days else _MONTH


def fact_cell(star: Star, subject: str, fact: DataFrame | None = None, days: bool = False) -> DataFrame:
    """The fact with month (or day) columns; rows without a calendar day keep NULLs,
    since cubes without a time axis count them."""
    rows = star[SUBJECTS[subject].fact] if fact is None else fact
    return with_calendar(star, rows, _time_columns(days), "left")


def widest_cell(star: Star, specs: Sequence[CubeSpec], fact: DataFrame | None = None, days: bool | None = None) -> DataFrame:
    """The sums from which all of ``specs`` can be made."""
    subject = specs[0].subject
    days = by_day(specs) if days is None else days
    columns = (*_time_columns(days), *SUBJECTS[subject].keys)
    return fact_cell(star, subject, fact, days).groupBy(*columns).agg(*[m.first_sum() for m in measures_of(specs)])


def widest_cell_pays(star: Star, subject: str, share: float = 0.5, days: bool = False) -> bool:
    """Whether the widest cell is clearly smaller than the fact: an estimate of
    its size in one pass with fixed memory."""
    what = SUBJECTS[subject]
    cell_rows, fact_rows = (
        fact_cell(star, subject, days=days)
        .agg(
            F.approx_count_distinct(F.struct(*_time_columns(days), *what.keys)).alias("cells"),
            F.count(F.lit(1)).alias("rows"),
        )
        .first()
    )
    return cell_rows <= share * fact_rows


def narrower(subject: str, cell: DataFrame, axes: Axes, merged: bool, measures: Sequence[Measure] | None = None) -> DataFrame:
    """Sum a cell down to ``axes``."""
    what = SUBJECTS[subject]
    columns = [*(_time_columns("D" in axes) if "T" in axes else ()), *[k for k in what.keys if k in axes]]
    return cell.groupBy(*columns).agg(*[m.sum_of(merged) for m in measures or what.measures])


def _month_axes(subject: str) -> list[Axes]:
    """The eight cells without days, the widest first."""
    axes = ("T", *SUBJECTS[subject].keys)
    return [frozenset(c) for size in (3, 2, 1, 0) for c in combinations(axes, size)]


def _smaller_cells(cells: Mapping[Axes, tuple[DataFrame, bool]], wanted: Iterable[Axes], subject: str, rows: int, share: float = 0.5) -> set[Axes]:
    """Those of the cells ``wanted`` that are clearly smaller than the smallest wider one
    that there is: estimates with fixed memory, in one pass over each widest cell."""
    size = {axes: df.count() if merged else rows for axes, (df, merged) in cells.items()}
    smaller = set()
    for days in (False, True):
        asked = [a for a in wanted if ("D" in a) == days]
        if not asked:
            continue
        columns = {a: [*(_time_columns(days) if "T" in a else ()), *[k for k in SUBJECTS[subject].keys if k in a]] for a in asked}
        counts = [F.approx_count_distinct(F.struct(*columns[a])) if columns[a] else F.lit(1) for a in asked]
        widest, _ = cells[min((a for a in cells if all(x <= a for x in asked)), key=len)]
        for axes, n in sorted(zip(asked, widest.agg(F.count(F.lit(1)), *counts).first()[1:], strict=True), key=lambda x: -len(x[0])):
            if n <= share * min(size[a] for a in size if axes < a):
                size[axes] = n
                smaller.add(axes)
    return smaller


class KeyCells:
    """The key cells of one subject, each with whether it holds sums already."""

    def __init__(
        self,
        star: Star,
        subject: str,
        cells: dict[Axes, tuple[DataFrame, bool]],
        folder: str | None = None,
        measures: Sequence[Measure] | None = None,
    ):
        self.star, self.subject, self.cells, self.folder = star, subject, cells, folder
        self.measures = tuple(measures or SUBJECTS[subject].measures)
        self._rows: dict[Axes, int] = {}

    def rows(self, axes: Axes) -> int:
        """Rows of a stored or kept cell, counted once; of the fact those counted before."""
        if axes not in self._rows:
            df, merged = self.cells[axes]
            self._rows[axes] = df.count() if merged else self.star.rows[SUBJECTS[self.subject].fact]
        return self._rows[axes]

    def remove(self, spark: SparkSession) -> None:
        """Delete the stored cells; nothing can be read from them any more."""
        if self.folder:
            remove_folder(spark, self.folder)

    @classmethod
    def staged(cls, star: Star, subject: str, specs: Sequence[CubeSpec] | None = None, only_smaller: bool = False) -> KeyCells:
        """Store the cells that several cubes read: the eight without days, and by day
        those that ``specs`` need. A widest one is stored only where it saves reading;
        otherwise the fact stands in for it. With ``only_smaller`` that holds for all
        cells: one that is not clearly smaller than a wider one is not stored."""
        specs = specs or specs_for(subject)
        measures = measures_of(specs)
        months = _month_axes(subject)
        widest, wanted = months[0], set(months[1:])
        cells: dict[Axes, tuple[DataFrame, bool]] = {}
        folder = new_folder(star.spark, f"cells-{subject}")
        if by_day(specs):
            wanted |= {s.axes for s in specs if "D" in s.axes and s.axes != widest | {"D"}}
            if widest_cell_pays(star, subject, days=True):
                by_days = stage_at(widest_cell(star, specs, days=True), f"{folder}/widest-days")
                cells[widest | {"D"}] = (by_days, True)
            else:
                cells[widest | {"D"}] = (fact_cell(star, subject, days=True), False)
        if widest_cell_pays(star, subject):
            if widest | {"D"} in cells:
                df, merged = cells[widest | {"D"}]
                sums = narrower(subject, df, widest, merged, measures)
            else:
                sums = widest_cell(star, specs, days=False)
            cells[widest] = (stage_at(sums, f"{folder}/widest"), True)
        else:
            cells[widest] = (fact_cell(star, subject), False)
        if only_smaller:
            wanted = _smaller_cells(cells, wanted, subject, star.rows[SUBJECTS[subject].fact])

        def store(axes: Axes) -> tuple[Axes, DataFrame]:
            df, merged = cells[min((a for a in cells if axes < a), key=len)]
            name = "-".join(["axes", *sorted(axes)])
            return axes, stage_at(narrower(subject, df, axes, merged, measures), f"{folder}/{name}")

        # Level by level: a cell is summed from one with a single axis more.
        with ThreadPoolExecutor(3) as pool:
            for size in (3, 2, 1, 0):
                level = [axes for axes in wanted if len(axes) == size]
                found = list(pool.map(inheritable_thread_target(star.spark)(store), level))
                cells.update({axes: (df, True) for axes, df in found})
        return cls(star, subject, cells, folder, measures)

    @classmethod
    def kept(cls, star: Star, specs: Sequence[CubeSpec], fact: DataFrame) -> KeyCells:
        """The cells that ``specs`` need of some rows of the fact, kept by the executors until
        ``release``: the rows with their keys, and of the sums those clearly smaller than
        what they are made of. Should an executor be lost, they are made again."""
        subject, measures = specs[0].subject, measures_of(specs)
        days = by_day(specs)
        full = _month_axes(subject)[0] | ({"D"} if days else frozenset())
        sources = dict.fromkeys(m.source for m in measures if m.source)
        rows = fact_cell(star, subject, fact, days).select(*_time_columns(days), *SUBJECTS[subject].keys, *sources).persist()
        cells, n = {full: (rows, False)}, rows.count()
        wanted = {*_month_axes(subject), *(s.axes for s in specs)} - {full}
        for axes in sorted(_smaller_cells(cells, wanted, subject, n), key=lambda a: (-len(a), sorted(a))):
            df, merged = cells[min((a for a in cells if axes < a), key=lambda a: (len(a), sorted(a)))]
            cells[axes] = (narrower(subject, df, axes, merged, measures).persist(), True)
        found = cls(star, subject, cells, measures=measures)
        found._rows[full] = n
        return found

    def release(self) -> None:
        for df, _ in self.cells.values():
            df.unpersist()

    def holding(self, axes: Axes) -> Axes:
        """The axes of the smallest stored (or kept) cell that has ``axes``."""
        return min((a for a in self.cells if axes <= a), key=lambda a: (len(a), sorted(a)))

    def cell(self, axes: Axes) -> tuple[DataFrame, bool]:
        df, merged = self.cells[axes if axes in self.cells else self.holding(axes)]
        # Rows outside the calendar take part only where time does not.
        return (df.filter(F.col("nam").isNotNull()) if "T" in axes else df), merged

    def exact_cube(self, spec: CubeSpec) -> DataFrame:
        df, merged = self.cell(spec.axes)
        return group_cell(self.star, df, spec, merged, once=self.folder is not None)  # stored cells were grouped

    def cube(self, spec: CubeSpec) -> DataFrame:
        return report_types(self.exact_cube(spec), spec)


# --- all cells in one frame --------------------------------------------------


def lattice_columns(specs: Sequence[CubeSpec]) -> list[str]:
    """Grouping columns in the fixed order that numbers the bits of ``gid``."""
    used = {c for s in specs for c in s.group}
    order = (*TIME_COLUMNS, "maKH", "loaiKhachHang", "maMH", "tenMH", "mien", "tenThanhPho", "maCH")
    if used - set(order):
        raise ValueError(f"key cells do not hold {sorted(used - set(order))}")
    return [c for c in order if c in used]


def spec_gid(spec: CubeSpec, columns: Sequence[str]) -> int:
    """Bit per column, set when the column is not grouped, first column highest:
    the value ``grouping_id`` gives over ``columns``."""
    return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in spec.group)


def lattice(cells: KeyCells, specs: Sequence[CubeSpec]) -> DataFrame:
    """Rows of all ``specs`` with exact sums, told apart by ``gid``.

    Cubes without an id have few groups: those with the same key axes are the grouping
    sets of one pass over their key cell. Cubes with an id may have as many groups as
    there are rows: their rows are dealt by the key of the id, once for those with a time
    and once for those without, and grouped where they are.
    """
    columns = lattice_columns(specs)
    families: dict[Axes, list[CubeSpec]] = defaultdict(list)
    dealt: dict[tuple[str, bool], list[CubeSpec]] = defaultdict(list)
    for spec in {frozenset(s.group): s for s in specs}.values():  # cubes with the same groups share rows
        anchor = _anchor(spec)
        if anchor is None:
            families[spec.axes].append(spec)
        else:
            dealt[anchor, "T" in spec.axes].append(spec)
    return reduce(
        DataFrame.unionByName,
        [
            *[_family(cells, family, columns) for family in families.values()],
            *[_with_ids(cells, anchor, timed, some, columns) for (anchor, timed), some in dealt.items()],
        ],
    )


def _anchor(spec: CubeSpec) -> str | None:
    """The key whose id the cube groups by; of two the one that does not give the place."""
    what = SUBJECTS[spec.subject]
    found = [key for key, (_, labels) in what.labels.items() if labels[0] in spec.group]
    return min(found, key=lambda key: key == what.place_key, default=None)


def _family(cells: KeyCells, family: Sequence[CubeSpec], columns: Sequence[str]) -> DataFrame:
    """The cubes of the same key axes, none of which groups by an id."""
    star, subject = cells.star, cells.subject
    used = [c for c in columns if any(c in s.group for s in family)]
    if not used:
        counted = tuple(m for m in cells.measures if m not in SUBJECTS[subject].measures)
        return cells.exact_cube(replace(family[0], extra=counted)).select(
            F.lit(spec_gid(family[0], columns)).alias("gid"),
            *[F.lit(None).cast(_type_of(star, subject, c)).alias(c) for c in columns],
            *[m.name for m in cells.measures],
        )
    axes = family[0].axes
    cell, merged = cells.cells[cells.holding(axes)]
    if "T" in axes:
        cell = cell.filter(F.col("nam").isNotNull())
    base, merged = labelled(star, cell, subject, used, merged, keep_unplaced=True)
    # A set by place also groups by whether there is one, so that the rows
    # without an office can be left out of these sets and no others.
    flag = [PLACED] if PLACED in base.columns else []
    sets = [[*s.group, *(c for c in flag if any(p in s.group for p in PLACE_COLUMNS))] for s in family]
    # The sets are made of the few groups by all their columns, not of the rows.
    base = base.groupBy(*used, *flag).agg(*[m.sum_of(merged) for m in cells.measures])
    grouped = _summed_sets(base, sets, [*used, *flag], [m.merged_sum() for m in cells.measures])
    if flag:
        grouped = grouped.filter(F.coalesce(PLACED, F.lit(True)))
    return _numbered(cells, grouped, columns, used)


def _with_ids(cells: KeyCells, anchor: str, timed: bool, family: Sequence[CubeSpec], columns: Sequence[str]) -> DataFrame:
    """Cubes that group by the id of ``anchor``, all with a time or all without.

    The rows travel with their keys only. Labels are looked up where the rows are grouped:
    in broadcast tables, or, for a larger dimension of ``anchor``, in its rows dealt by the
    same key. Only other larger dimensions are joined before.
    """
    star, subject = cells.star, cells.subject
    what = SUBJECTS[subject]
    used = [c for c in columns if any(c in s.group for s in family)]
    asked = frozenset().union(*(s.axes for s in family))
    axes = cells.holding(asked)
    rows, (cell, merged) = cells.rows(axes), cells.cells[axes]
    keys = [key for key in what.keys if key in asked]
    time = [c for c in TIME_COLUMNS if c in used]
    if timed:
        cell = cell.filter(F.col("nam").isNotNull())
    sources = dict.fromkeys(c for c in (m.name if merged else m.source for m in cells.measures) if c)
    cell = cell.select(*time, *keys, *sources)
    unique = anchor in late_keys(star, subject, used)
    by = [anchor if unique else what.labels[anchor][1][0], *(c for c in time if all(c in s.group for s in family))]
    parts = _parts(rows, len(family))
    sums = [m.sum_of(merged) for m in cells.measures]
    after = []
    if unique and axes != asked:  # the cell is finer than what is asked of it
        narrow = sums
        after.append(lambda df: df.groupBy(*time, *keys).agg(*narrow))
        sums = [m.merged_sum() for m in cells.measures]
    for key in keys:
        table, (id_name, *_) = what.labels[key]
        how = "inner" if all(key in s.axes for s in family) else "left"
        lookup = label_table(star, subject, key, labels_of(subject, key, used), keep_unplaced=True).withColumn(f"_in_{key}", F.lit(True))
        ids = [c for c in lookup.columns if c == id_name]
        late = key != anchor or unique
        if fits_broadcast(lookup, star.rows[table]):
            join = lambda df, key=key, lookup=lookup, how=how: df.join(F.broadcast(lookup), key, how)
        elif packed := star.packed(lookup, table, key, ids):
            join = lambda df, key=key, packed=packed, how=how: join_packed(df, packed, key, how)
        elif key == anchor and unique:
            with_years = by[1:2] if timed else []
            if with_years:
                years = [r[0] for r in star["Dim_ThoiGian"].select("nam").distinct().collect()]
                if by[1] == "nam" and star.rows[table] * len(years) <= rows:
                    lookup = lookup.withColumn("nam", F.explode(F.array(*[F.lit(y) for y in years])))
                else:
                    with_years = []
            by = [anchor, *with_years]
            join = lambda df, on=tuple(by), there=lookup.repartition(parts, *by): df.join(there, list(on), "inner")
        else:
            late = False
            join = lambda df, key=key, lookup=lookup, how=how: df.join(lookup, key, how)
        if late:
            after.append(join)
        else:
            cell = join(cell)
    grouping = [*([anchor] if unique else []), *used]
    sets = [[*grouping[: int(unique)], *s.group] for s in family]

    def counts(spec: CubeSpec) -> Column:
        """Whether a row counts in the cube: its members are known, and so is its place where asked."""
        known = [F.col(f"_in_{key}") for key in keys if key in spec.axes]
        placed = [F.col(PLACED)] if any(c in PLACE_COLUMNS for c in spec.group) else []
        return reduce(lambda a, b: a & b, [*known, *placed])

    grouped = _dealt_sets(cell, sets, grouping, sums, rows, by, lambda df: reduce(lambda x, step: step(x), after, df), [counts(s) for s in family])
    return _numbered(cells, grouped, columns, used)


def _numbered(cells: KeyCells, grouped: DataFrame, columns: Sequence[str], used: Sequence[str]) -> DataFrame:
    """The sets with their ``gid``, and NULL in the columns that none of them has."""
    gid: Column = F.lit(0)
    for i, c in enumerate(columns):
        absent = F.col(f"_no_{c}").cast("int") if c in used else F.lit(1)
        gid = gid + absent * (1 << (len(columns) - 1 - i))
    return grouped.select(
        gid.cast("int").alias("gid"),
        *[F.col(c) if c in used else F.lit(None).cast(_type_of(cells.star, cells.subject, c)).alias(c) for c in columns],
        *[m.name for m in cells.measures],
    )


#: Rows times sets that one task groups where the rows are dealt before.
GROUPED_ROWS = 1_000_000


def _summed_sets(base: DataFrame, sets: Sequence[Sequence[str]], grouping: Sequence[str], sums: Sequence[Column]) -> DataFrame:
    """Grouping sets of few groups: sums are made map-side, and only they are shuffled."""
    asked = [[F.col(c) for c in s] for s in sets]
    return base.groupingSets(asked, *[F.col(c) for c in grouping]).agg(*sums, *[F.grouping(c).alias(f"_no_{c}") for c in grouping])


def _parts(rows: int, sets: int) -> int:
    return max(1, -(-rows * sets // GROUPED_ROWS))


def _dealt_sets(
    base: DataFrame,
    sets: Sequence[Sequence[str]],
    grouping: Sequence[str],
    sums: Sequence[Column],
    rows: int,
    by: Sequence[str] | None = None,
    there: Callable[[DataFrame], DataFrame] = lambda df: df,
    counts: Sequence[Column] | None = None,
) -> DataFrame:
    """Grouping sets with nearly as many groups as rows, where sums made map-side would
    shuffle every row once for each set. The rows are dealt once by the columns that all
    sets have (or ``by`` some of them), are multiplied by the sets in the task that has them,
    and grouped there. ``there`` is done to the dealt rows first; ``counts`` tells for each
    set whether a row takes part."""
    shared = [c for c in sets[0] if all(c in s for s in sets)]
    dealt = there(base.repartition(_parts(rows, len(sets)), *(by or shared)))
    numbers = F.array(*[F.lit(i) for i in range(len(sets))])
    if counts:
        numbers = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(counts)]))
    dealt = dealt.withColumn("_set", F.explode(numbers))
    absent = {c: [i for i, s in enumerate(sets) if c not in s] for c in grouping}
    others = {c: F.when(~F.col("_set").isin(absent[c]), F.col(c)) for c in grouping if c not in shared and absent[c]}
    grouped = dealt.withColumns(others).groupBy("_set", *grouping).agg(*sums)
    return grouped.withColumns({f"_no_{c}": F.col("_set").isin(absent[c]).cast("tinyint") for c in grouping}).drop("_set")


def _type_of(star: Star, subject: str, column: str) -> str:
    if column in TIME_COLUMNS:
        return star["Dim_ThoiGian"].schema[column].dataType.simpleString()
    if column in PLACE_COLUMNS:
        return star["Dim_DiaDiem"].schema[column].dataType.simpleString()
    for table, labels in SUBJECTS[subject].labels.values():
        if column in labels:
            return star[table].schema[column].dataType.simpleString()
    raise KeyError(column)


def build_lattice(star: Star, subject: str, dims: Iterable[int] = (0, 1, 2, 3)) -> DataFrame:
    specs = specs_for(subject, dims)
    rows = lattice(KeyCells.staged(star, subject, only_smaller=True), specs)
    return rows.select(
        "gid", *lattice_columns(specs), *[m.report() for m in SUBJECTS[subject].measures]
    )


def lattice_cube(rows: DataFrame, spec: CubeSpec, specs: Sequence[CubeSpec]) -> DataFrame:
    """One cube read out of the lattice. NULL keys and columns that are not
    grouped differ only by ``gid``."""
    return rows.filter(F.col("gid") == spec_gid(spec, lattice_columns(specs))).select(*spec.columns)


# --- stored cubes ------------------------------------------------------------

#: How much a grouping column adds to the size of a cube, for choosing the smallest parent.
_WEIGHT = {"nam": 1, "quy": 1, "thang": 2, "ngay": 5, "loaiKhachHang": 1, "mien": 1, "tenThanhPho": 3, "tenMH": 0}
_ID_WEIGHT = 9


def weight(group: Iterable[str]) -> int:
    return sum(_WEIGHT.get(c, _ID_WEIGHT) for c in group)


@dataclass(frozen=True)
class RollUp:
    """How the cubes of one family (same facts) come out of each other: ``base`` is the
    grouping by all their columns, and each cube has a parent: an earlier cube, or None
    for the base."""

    base: CubeSpec
    steps: tuple[tuple[CubeSpec, CubeSpec | None], ...]


def ids_of(spec: CubeSpec) -> set[str]:
    return {labels[0] for _, labels in SUBJECTS[spec.subject].labels.values()} & set(spec.group)


def quarter_of(group: Iterable[str]) -> set[str]:
    """The columns that a grouping gives: a month tells its quarter."""
    return {*group, *(("quy",) if "thang" in group else ())}


def roll_up_plan(specs: Sequence[CubeSpec]) -> list[RollUp]:
    """A tree over the cubes of each family, from the widest to the smallest: every cube
    is summed from the smallest one that has its columns and is finished by then."""
    families: dict[tuple, list[CubeSpec]] = defaultdict(list)
    for spec in specs:
        families[spec.axes, any(c in PLACE_COLUMNS for c in spec.group)].append(spec)
    plans = []
    for family in families.values():
        columns = tuple(dict.fromkeys(c for s in family for c in s.group))
        order = sorted(family, key=lambda s: (-weight(s.group), s.name))
        steps = []
        for i, spec in enumerate(order):
            wider = [p for p in order[:i] if set(spec.group) <= quarter_of(p.group) and set(spec.measures) <= set(p.measures)]
            steps.append((spec, min(wider, key=lambda p: (weight(p.group), p.name), default=None)))
        counted = tuple(dict.fromkeys(m for s in family for m in s.extra))
        plans.append(RollUp(CubeSpec("base", family[0].subject, columns, 0, counted), tuple(steps)))
    return plans


def implied(star: Star, subject: str, group: Sequence[str]) -> set[str]:
    """The columns that have one value in each group: the quarter of a month, and the
    labels and place of a member whose id is unique."""
    found = quarter_of(group)
    for key in late_keys(star, subject, group):
        found |= {*SUBJECTS[subject].labels[key][1], *(PLACE_COLUMNS if key == SUBJECTS[subject].place_key else ())}
    return found


def with_quarter(cube: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The cube with the quarter of its months, where that is wanted and not stored."""
    if "quy" in wanted and "quy" not in cube.columns:
        return cube.withColumn("quy", F.ceil(F.col("thang") / 3).cast("int"))
    return cube


def rolled_up(parent: DataFrame, spec: CubeSpec) -> DataFrame:
    """The cube from the sums of a wider one."""
    return with_quarter(parent, spec.group).groupBy(*spec.group).agg(*[m.merged_sum() for m in spec.measures]).select(*spec.columns)


def build_cubes(
    star: Star,
    path: str,
    subject: str,
    dims: Iterable[int] = (0, 1, 2, 3),
    at_once: int = 8,
    more: Sequence[CubeSpec] = (),
) -> list[str]:
    """Store every cube of ``subject`` (with ``dims``, and ``more``, such as cubes by day
    or with line counts) under ``path`` with exact sums. A rerun replaces the old cubes
    when all new ones are complete. ``open_cube`` reads one with its reported types.

    Cubes are summed from the smallest stored one that has their columns. Only those
    without such a cube read their key cell and look up labels, or, where several of a
    family have the same ids, the family's widest grouping, which is stored for them: it has
    nearly as many rows as the cell, so cubes with fewer ids group the cell by shorter
    values. Families are independent, so a few are sent to Spark at a time.
    """
    specs = [*specs_for(subject, dims), *more]
    cells = KeyCells.staged(star, subject, specs)
    draft = f"{path}/_draft-{uuid.uuid4().hex}"

    def store_base(plan: RollUp) -> DataFrame | None:
        """The stored base of a family; none where it would serve a single cube."""
        if sum(parent is None and ids_of(spec) == ids_of(plan.base) for spec, parent in plan.steps) < 2:
            return None
        return stage_at(cells.exact_cube(plan.base), f"{cells.folder}/base-{uuid.uuid4().hex}")

    def store(plan: RollUp, spec: CubeSpec, parent: CubeSpec | None, after: Future) -> str:
        whole = after.result()
        if parent is not None:
            cube = rolled_up(star.spark.read.parquet(f"{draft}/{parent.name}"), spec)
        elif whole is None or ids_of(spec) != ids_of(plan.base):
            cube = cells.exact_cube(spec)
        elif set(plan.base.group) <= implied(star, subject, spec.group):
            cube = whole.select(*spec.columns)
        else:
            cube = rolled_up(whole, spec)
        cube.write.parquet(f"{draft}/{spec.name}")
        return spec.name

    try:
        wrap = inheritable_thread_target(star.spark)
        plans = sorted(roll_up_plan(specs), key=lambda p: -len(p.steps))
        steps = sorted(((p, spec, parent) for p in plans for spec, parent in p.steps), key=lambda x: (-weight(x[1].group), x[1].name))
        with ThreadPoolExecutor(at_once) as pool:
            # parents are handed in before their children, so no task waits for one behind it
            bases = {p.base.group: pool.submit(wrap(store_base), p) for p in plans}
            done: dict[str, Future] = {}
            for plan, spec, parent in steps:
                after = bases[plan.base.group] if parent is None else done[parent.name]
                done[spec.name] = pool.submit(wrap(store), plan, spec, parent, after)
            names = [f.result() for f in done.values()]
        for name in names:
            remove_folder(star.spark, f"{path}/{name}")
            move_folder(star.spark, f"{draft}/{name}", f"{path}/{name}")
    finally:
        remove_folder(star.spark, draft)
        cells.remove(star.spark)
    return names


def cube_exists(spark: SparkSession, path: str, name: str) -> bool:
    """Whether the cube ``name`` was stored completely under ``path``."""
    return exists(spark, f"{path}/{name}/_SUCCESS")


def open_cube(spark: SparkSession, path: str, spec: CubeSpec) -> DataFrame:
    return report_types(spark.read.parquet(f"{path}/{spec.name}"), spec)


def same_rows(subject: str, spec: CubeSpec, group: Sequence[str]) -> bool:
    """Whether the cube holds exactly the facts that ``group`` asks for: a cube leaves
    out facts without a key on its axes, and by place also those without an office."""
    asked = CubeSpec("asked", subject, tuple(group), 0)
    placed = [any(c in PLACE_COLUMNS for c in s.group) for s in (spec, asked)]
    return spec.axes == asked.axes and placed[0] == placed[1]


def only_where(rows: DataFrame, where: Mapping[str, object]) -> DataFrame:
    for column, value in where.items():
        rows = rows.filter(F.col(column).isin(list(value) if isinstance(value, (list, tuple, set)) else [value]))
    return rows


def answer_from_cube(
    spark: SparkSession,
    path: str,
    subject: str,
    group: Sequence[str],
    rows: dict[str, int],
    extra: Sequence[Measure] = (),
    where: Mapping[str, object] | None = None,
) -> tuple[str, DataFrame]:
    """Answer a grouping from the smallest stored cube that has its columns (a month
    gives its quarter), the same facts and the measures ``extra``. Without such a cube a
    LookupError tells the caller to ask the fact.

    ``where`` keeps one value, or a list of values, of grouping columns; the cube must have
    these too, and they are asked of its files. ``rows`` gives the row count of each
    stored cube. All measures are additive, so the cube's sums are summed again.
    """
    where = where or {}
    asked = list(dict.fromkeys((*group, *where)))
    covering = [
        s for s in CUBES.values()
        if s.subject == subject and s.name in rows and set(asked) <= quarter_of(s.group)
        and set(extra) <= set(s.measures) and same_rows(subject, s, asked)
    ]
    if not covering:
        raise LookupError(f"no stored cube answers {asked}")
    spec = min(covering, key=lambda s: (rows[s.name], s.name))
    cube = only_where(with_quarter(spark.read.parquet(f"{path}/{spec.name}"), asked), where)
    measures = (*SUBJECTS[subject].measures, *extra)
    merged = cube.groupBy(*group).agg(*[m.merged_sum() for m in measures])
    return spec.name, merged.select(*group, *[m.report() for m in measures])
