"""The stratified split by counts of hash prefixes against the split by rank."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions.core import hash_order
from riskframe.operators import features as FE
from riskframe.operators.ordered import rank_within


def by_rank(df, label, key, share, seed=42):
    r = rank_within(df.withColumn("_h", hash_order(seed, F.col(key))), [label], ["_h", key], "_rk")
    n = {x[label]: x["count"] for x in df.groupBy(label).count().collect()}
    return sorted(x[key] for x in r.collect() if x["_rk"] < math.ceil(n[x[label]] * share))


@pytest.mark.parametrize("few", [20_000, 1])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_same_rows_as_by_rank(spark, monkeypatch, few, kind):
    monkeypatch.setattr(FE, "FEW_ROWS", few)
    df = spark.range(5_000).select(F.col("id").cast(kind).alias("k"), F.when(F.col("id") % 97 == 0, 2).when(F.col("id") % 3 == 0, 1).otherwise(0).alias("y"))
    for share in (0.2, 0.001, 1.0):
        got = FE.stratified_split(df, "y", "k", share)
        assert got.count() == 5_000 and got.columns == ["y", "k", "split"]
        assert sorted(r["k"] for r in got.where("split = 'test'").collect()) == by_rank(df, "y", "k", share)


def test_nothing_is_shuffled(spark):
    df = spark.range(1_000).selectExpr("id AS k", "id % 2 AS y", "id * 2 AS v")
    plan = FE.stratified_split(df, "y", "k")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "Window" not in plan


def test_equal_keys_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, 7)] * 50 + [(1, 8)] * 50 + [(0, None)] * 4 + [(0, k) for k in range(6)] + [(None, 1)], "y int, k int")
    got = FE.stratified_split(df, "y", "k", 0.2)
    assert got.count() == 110
    assert got.where("y = 1").groupBy("k").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert {r["k"] for r in got.where("y = 0 AND split = 'test'").collect()} == {None}
    assert FE.stratified_split(df.where("false"), "y", "k").count() == 0
