"""A Merkle manifest of a dataset, with nested-interval labels.

Every row is a leaf: the digest of its fields. The leaves of a group (a source) are
ranked in the order of their ids, and every ``arity`` consecutive nodes become their
parent until one node remains, the group's subroot; the subroots, ordered by group,
become the root in the same way.

A node is labelled with the interval of leaf ranks it covers. Levels are built
bottom-up, one grouping each, and stored. Paths are attached top-down: the nodes of a
level meet the nodes above in a containment join (child interval inside parent
interval), bucketed by the level's interval width so that it is an equi-join. In the
parent, the intervals that differ from the child's own are its siblings: those that
end before it go to the left, those that begin after it to the right. A subroot brings
its path to the root along, so no group's rows are ever joined by the group.

Ranks come from a range shuffle on (group, id, leaf), positions in the partitions, and
one offset for each partition and group; a group that holds most rows is spread over
many partitions. All joins and groupings are on (group, bucket) with at most ``arity``
children each. Texts are read once; after that only digests move. What is stored goes
into as many files as its rows need, not one for each shuffle partition: every file
costs its executor a few processes on a local file system.

Defined cases: a null field is ``-`` and an empty text ``0:``; a null group is a group of
its own, before all others; rows without an id come first in their group; rows with
the same group and id are ordered by their leaf, and equal rows are separate leaves
with equal digests; a lone leaf is its group's subroot and a lone subroot the root;
an empty table has no rows and no root. Extra columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarcube.llm.tables import shuffle_parts
from bazaarcube.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
FILE_ROWS = 20_000
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below


def digest_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(values: list[Column]) -> Column:
    """The digest of some fields: ``-`` for null, else byte count, colon, value."""
    text = [v.cast("string") for v in values]
    parts = [F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in text]
    return digest_of(F.concat(*parts))


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in tasks of about FILE_ROWS."""
    return df.coalesce(max(1, math.ceil(rows / FILE_ROWS)))


def ranked(rows: DataFrame, order: list[str], count: int) -> DataFrame:
    """``rows`` (``count``, with ``grp``) and their interval in their group: ``lo`` =
    ``hi`` = the rank by ``order`` from 0, and ``n``, the number of the group's rows."""
    parts = shuffle_parts(rows.sparkSession)
    slot = F.monotonically_increasing_id()
    placed = (
        rows.repartitionByRange(parts, "grp", *order).sortWithinPartitions("grp", *order)
        .withColumn("part", F.shiftright(slot, _POSITION_BITS))
        .withColumn("place", slot.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    )
    placed = stage(_packed(placed, count), "ranked")
    blocks = placed.groupBy("part", "grp").agg(F.count("*").alias("size"), F.min("place").alias("first"))
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "part", "grp", (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(Window.partitionBy("grp")).alias("n"),
    )
    lo = F.col("place") + F.col("shift")
    return placed.join(offsets, ["part", "grp"]).withColumns({"lo": lo, "hi": lo}).drop("part", "place", "shift")


def _run(level: int, arity: int) -> Column:
    """The bucket of an interval of ``level`` - 1: its parent's number in its group."""
    return F.expr(f"lo div {arity**level}L")


@dataclass
class Tree:
    """Stored nodes (grp, level, lo, hi, n, digest, kids) of the levels from 1 up, and
    the leaves; ``rows`` and ``groups``: how many; ``roots``: each group's topmost node."""

    leaves: DataFrame
    levels: list[DataFrame]
    arity: int
    rows: int
    groups: int

    def most(self, level: int) -> int:
        """No level has more nodes than this."""
        return self.rows // self.arity**level + self.groups

    @property
    def roots(self) -> DataFrame:
        whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)
        lone = self.leaves.filter("n = 1").select("grp", F.lit(0).alias("level"), "digest")
        return reduce(DataFrame.union, [lone, *(df.filter(whole).select("grp", "level", "digest") for df in self.levels)])


def grow(leaves: DataFrame, arity: int = ARITY) -> Tree:
    """The tree over ``leaves`` (grp, lo, hi, n, digest)."""
    most, rows, groups = leaves.agg(F.max("n"), F.count("*"), F.count_if(F.col("lo") == 0)).first()
    tree = Tree(leaves, [], arity, rows, groups)
    levels, below, width = tree.levels, leaves, 1
    while width < (most or 0):
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        width *= arity
        runs = (
            below.filter(F.col("n") > width // arity)  # a group with one node left is done
            .groupBy("grp", _run(len(levels) + 1, arity).alias("run"))
            .agg(F.max("n").alias("n"), kids.alias("kids"))
        )
        nodes = runs.select(
            "grp", F.lit(len(levels) + 1).alias("level"), F.col("kids")[0]["lo"].alias("lo"),
            F.element_at("kids", -1)["hi"].alias("hi"), "n", digest_of(F.array_join("kids.digest", "")).alias("digest"), "kids",
        )
        below = stage(_packed(nodes, tree.most(len(levels) + 1)), "merkle-level")
        levels.append(below)
    return tree


_NO_PATH = "CAST(array() AS array<struct<l:string,r:string>>)"


def attach_paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """The leaves with ``path``: for each level from their own to the end of the path
    of their group's root, the digests left and right of the way. ``tops``: grp, path
    of the root, and columns that all leaves of the group are to get."""
    more = [c for c in tops.columns if c not in ("grp", "path")]
    roots = stage(_packed(tree.roots.select("grp", "level").join(tops, "grp"), tree.groups), "merkle-subroots")
    above: DataFrame | None = None
    for level in range(len(tree.levels), -1, -1):
        nodes = tree.levels[level - 1].drop("level") if level else tree.leaves
        mine = roots.filter(F.col("level") == level).drop("level")
        here = nodes.filter((F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)).join(mine, "grp")
        if above is not None:
            child, parent = nodes.withColumn("bucket", _run(level + 1, tree.arity)).alias("c"), above.alias("p")
            inside = (
                (F.col("c.grp") == F.col("p.grp")) & (F.col("c.bucket") == F.col("p.bucket"))
                & (F.col("c.lo") >= F.col("p.lo")) & (F.col("c.hi") <= F.col("p.hi"))
            )
            left = F.filter("p.kids", lambda k: k["hi"] < F.col("c.lo"))
            right = F.filter("p.kids", lambda k: k["lo"] > F.col("c.hi"))
            step = F.struct(_joined(left).alias("l"), _joined(right).alias("r"))
            lower = child.join(parent, inside).select(
                *(f"c.{c}" for c in nodes.columns), F.concat(F.array(step), "p.path").alias("path"), *(f"p.{c}" for c in more)
            )
            here = lower.unionByName(here)
        here = _packed(here, tree.most(level))
        if level:
            # Stored, so that the driver holds the plan of one level at a time, not of all.
            above = stage(
                here.withColumn("bucket", _run(level, tree.arity)).select("grp", "bucket", "lo", "hi", "kids", "path", *more), "merkle-paths"
            )
    return here


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda k: k["digest"]), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda acc, x: digest_of(F.concat(x["l"], acc, x["r"])))


def proofs(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    received: dict[str, Column] | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """``order``, leaf, received leaf, subroot, root and path of every row. ``received``:
    what arrived in place of some fields, as columns on ``docs``."""
    given = received or {}
    rows = docs.select(
        F.col(order).alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),  # null sorts first
        leaf_of([F.col(f) for f in fields]).alias("digest"),
        leaf_of([given.get(f, F.col(f)) for f in fields]).alias("received"),
    )
    tree = grow(ranked(rows, ["id", "digest"], docs.count()), arity)
    subroots = tree.roots.select(F.lit("").alias("grp"), F.col("grp").alias("id"), "digest")
    top = grow(ranked(subroots, ["id"], tree.groups), arity)
    root = top.roots.select("digest").first()
    end = top.leaves.sparkSession.range(1).select(F.lit("").alias("grp"), F.expr(_NO_PATH).alias("path"))
    tops = attach_paths(top, end).select(F.col("id").alias("grp"), "path", F.col("digest").alias("subroot"))
    found = attach_paths(tree, tops)
    return found.select(
        F.col("id").alias(order), F.col("digest").alias("leaf"), "received", "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"), "path",
    )


def verify(docs: DataFrame, received: dict[str, Column] | None = None, **kw) -> DataFrame:
    """Every row's leaf, subroot, root and proof, the root that the received row folds
    to, and whether that is the root."""
    found = proofs(docs, received=received, **kw)
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["l"], x["r"])), "")
    return (
        found.withColumn("proof_sha256", digest_of(siblings)).withColumn("folded_root", folded(F.col("received"), F.col("path")))
        .withColumn("verified", F.col("folded_root") == F.col("root")).drop("received", "path")
    )
