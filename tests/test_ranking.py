from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starsmelt.functions import stable_round
from starsmelt.operators.ranking import distinct_top


@pytest.mark.parametrize("seed", range(6))
def test_distinct_top_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 6) / 2, rng.choice([None, 1, 2]), rng.choice("abc")) for _ in range(300)]
    df = spark.createDataFrame(rows, "r double, c bigint, n string").repartition(5)
    df = df.withColumn("id", F.monotonically_increasing_id())
    order = [F.desc("r"), F.desc("c"), F.asc("n")]
    for size in (1, 5, 40, 500):
        found = [tuple(row) for row in distinct_top(df, ["r", "c", "n"], order, size, "id").collect()]
        ranked = sorted(set(rows), key=lambda t: (-t[0], -(t[1] or 0), t[2]))
        assert found == ranked[:size]


def test_distinct_top_of_nothing(spark):
    df = spark.createDataFrame([], "r double, n string")
    assert distinct_top(df, ["r", "n"], [F.desc("r"), F.asc("n")], 3, "n").collect() == []


def test_distinct_top_with_a_hot_copy(spark):
    hot = spark.range(20_000).select(F.lit(5.0).alias("r"), F.lit("same").alias("n"))
    rest = spark.range(40_000).select(
        (F.col("id") / 10_000).alias("r"), F.col("id").cast("string").alias("n"))
    rows = hot.unionByName(rest).withColumn("id", F.monotonically_increasing_id())
    top = distinct_top(rows, ["r", "n"], [F.desc("r"), F.asc("n")], 3, "id").collect()
    assert [row["n"] for row in top] == ["same", "39999", "39998"]


@pytest.mark.parametrize("value, digits, expected", [
    (1.005, 2, 1.01), (2.675, 2, 2.68), (0.125, 2, 0.13), (-0.125, 2, -0.13), (2.5, 0, 3.0),
    (2.4449999999999998, 2, 2.45), (None, 2, None),
])
def test_stable_round(spark, value, digits, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(stable_round(F.col("x"), digits)).first()[0] == expected
