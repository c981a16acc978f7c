from __future__ import annotations

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarcube.operators.keys import dense_keys


@pytest.mark.parametrize("rows, partitions", [(1, 1), (7, 3), (5000, 40)])
def test_equals_row_number(spark, rows, partitions):
    numbers = random.Random(rows).sample(range(10 * rows), rows)
    df = spark.createDataFrame([(n, f"x{n % 3}") for n in numbers], "n bigint, x string").repartition(partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep many range partitions
    try:
        keyed = dense_keys(df, ["n"], "sk")
        assert keyed.select("n", "x", "sk").exceptAll(
            df.withColumn("sk", F.row_number().over(W.orderBy("n")))
        ).isEmpty()
        assert keyed.count() == rows
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_text_keys_start_and_nulls(spark):
    df = spark.createDataFrame([("KH2",), ("KH10",), (None,), ("KH1",)], "k string")
    keyed = dense_keys(df, ["k"], "sk", start=11)
    assert {r["k"]: r["sk"] for r in keyed.collect()} == {None: 11, "KH1": 12, "KH10": 13, "KH2": 14}


def test_repeated_and_hot_keys_still_get_distinct_numbers(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    keyed = dense_keys(df, ["k"], "sk")
    row = keyed.agg(F.countDistinct("sk"), F.min("sk"), F.max("sk")).first()
    assert tuple(row) == (3000, 1, 3000)


def test_empty(spark):
    assert dense_keys(spark.createDataFrame([], "k string"), ["k"], "sk").count() == 0
