"""Connected components of a table of links, by alternating large and small stars.

Every round reconnects each vertex to the smallest vertex among its neighbours, which
halves the depth of the graph; the links of a vertex are never gathered in one place
(the minimum is a partial aggregation, and the join back splits hot vertices). Rounds
are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarcube.session import stage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) of every vertex that has a link to another; a component is
    named by its smallest vertex, which is listed too."""
    hi, lo = F.greatest(a, b), F.least(a, b)
    now = stage(links.select(hi.alias("u"), lo.alias("v")).filter("u <> v").distinct(), "stars")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        small = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: the larger neighbours move to the smallest vertex around
        large = now.select(F.col("v").alias("u"), F.col("u").alias("v")).join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: the vertex and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(least)
        now = stage(moved.distinct(), "stars")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.coalesce(F.sum(hashed), F.lit(0)), F.coalesce(F.bit_xor(F.xxhash64(F.lit(1), "u", "v")), F.lit(0))).first())
