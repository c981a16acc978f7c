from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaarcube.operators.quality import _range_of, _signed, differing_ranges, reconcile
from tests.conftest import values

SCHEMA = "ma string, n int, gia double"
LEFT = [("a", 1, 1.0), ("a", 1, 1.0), ("b", None, 2.0), ("c", 3, None), (None, 4, 4.0), ("d", 5, float("nan"))]
# one "a" less, NULLs in other places, a repeated row more
RIGHT = [("a", 1, 1.0), ("b", 2, None), ("c", 3, None), (None, 4, 4.0), (None, 4, 4.0), ("d", 5, float("nan"))]


def brute(left, right):
    def bag(df):
        return Counter(repr(tuple(r)) for r in df.collect())

    a, b = bag(left), bag(right)
    return sorted([(r, "trai", n) for r, n in (a - b).items()] + [(r, "phai", n) for r, n in (b - a).items()])


def found(left, right, key):
    return sorted((repr(tuple(r)[:-2]), r["phia"], r["soLan"]) for r in reconcile(left, right, key).collect())


@pytest.mark.parametrize(("left", "right"), [(LEFT, RIGHT), (LEFT, LEFT[::-1]), (LEFT, []), ([], RIGHT), ([], [])])
def test_finds_what_differs(spark, left, right):
    one, other = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    assert found(one, other.select("gia", "ma", "n"), ("ma",)) == brute(one, other)


def test_only_differing_ranges_are_looked_at_again(spark):
    """Three of 50,000 keys differ; one key has a third of all rows and is equal."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    rows = spark.range(50_000).select(key.alias("ma"), F.col("id").alias("n"))
    other = rows.withColumn("n", F.when(F.col("ma").isin(10, 20, 40_000), F.col("n") + 1).otherwise(F.col("n"))).repartition(13)
    both = _signed(rows, ("ma",), 1).unionByName(_signed(other, ("ma",), -1))
    coarse, fine = (differing_ranges(both, n).count() for n in (12, 24))
    assert (coarse, fine) == (3, 3)
    again = both.join(differing_ranges(both, 12).withColumnRenamed("_khoang", "r"), _range_of(12) == F.col("r"), "left_semi")
    assert again.count() < 200
    assert values(reconcile(rows, other, ("ma",))) == sorted(
        [(k, k + d, side, 1) for k in (10, 20, 40_000) for d, side in ((0, "trai"), (1, "phai"))]
    )


def test_other_columns_are_refused(spark):
    with pytest.raises(ValueError):
        reconcile(spark.range(1), spark.range(1).toDF("x"), ("id",))
