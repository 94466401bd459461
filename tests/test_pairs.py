"""Dot products of pairs by cells: the same rows as two joins, without a vector per pair."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.pairs import dot_pairs
from millrace.operators.semistruct import dot


@pytest.mark.parametrize("kind", ["float", "double"])
def test_cells_give_the_rows_of_two_joins(spark, kind):
    vectors = [(i, [0.1 * i, 1.0 / (i + 1), -0.3]) for i in range(40)]
    vectors += [(3, [1.0, 2.0, 3.0]), (3, [5.0, 6.0, 7.0]), (50, None), (51, [1.0, None, 2.0]), (52, [1.0, 2.0]), (53, []), (None, [1.0, 1.0, 1.0]),
                (54, [float("nan"), 0.0, 1.0])]
    v = spark.createDataFrame(vectors, f"k long, v array<{kind}>")
    pairs = spark.createDataFrame(
        [(n, n * 7 % 60, n * 11 % 56) for n in range(900)] + [(-1, None, 3), (-2, 3, None), (-3, 3, 3), (-3, 3, 3)], "name long, l long, r long")
    left, right = v.withColumnRenamed("k", "l"), v.withColumnRenamed("k", "r")
    wanted = pairs.join(left.withColumnRenamed("v", "x"), "l").join(right.withColumnRenamed("v", "y"), "r").select(
        "name", "l", "r", dot(F.col("x").cast("array<double>"), F.col("y").cast("array<double>")).alias("prediction"))
    rows = lambda df: sorted(map(str, df.select("name", "l", "r", "prediction").collect()))
    assert rows(dot_pairs(pairs, "l", "r", left, right, cells=3)) == rows(wanted)
    assert rows(dot_pairs(pairs, "l", "r", left, right)) == rows(wanted)


def test_vectors_do_not_travel_with_pairs(spark):
    v = spark.range(30_000).select("id", F.array(*[F.col("id").cast("float")] * 4).alias("v"))
    pairs = spark.range(100).select(F.col("id").alias("l"), F.col("id").alias("r"))
    scored = dot_pairs(pairs, "l", "r", v.withColumnRenamed("id", "l"), v.withColumnRenamed("id", "r"))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert scored.agg(F.sum("prediction")).first()[0] == sum(4.0 * i * i for i in range(100))
