import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskframe.operators import ordered


@pytest.fixture()
def skewed(spark):
    rnd = random.Random(1)
    rows = [(i, 1 if i % 3 else rnd.randint(2, 40), rnd.randint(0, 50), float(rnd.randint(0, 9))) for i in range(900)]
    return spark.createDataFrame(rows, "id long, k long, t long, v double")


@pytest.mark.parametrize("hot", [10, None])
def test_split_windows_equal_plain_windows(spark, skewed, hot):
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = (skewed.withColumn("nx", F.lead("v").over(w)).withColumn("rk", F.row_number().over(w) - 1)
           .withColumn("cs", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    a = ordered.next_within(skewed, "k", ["t", "id"], "v", "nx", min_hot_rows=hot)
    a = ordered.rank_within(a, "k", ["t", "id"], "rk", min_hot_rows=hot)
    a = ordered.running_sums(a, ["t", "id"], {"cs": "v"}, keys=["k"], min_hot_rows=hot)
    j = ref.alias("r").join(a.alias("a"), "id")
    bad = j.where(~F.col("r.nx").eqNullSafe(F.col("a.nx")) | (F.col("r.rk") != F.col("a.rk"))
                  | (F.abs(F.col("r.cs") - F.col("a.cs")) > 1e-9))
    assert j.count() == 900 and bad.count() == 0


def test_first_per_key_keeps_smallest_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 9, "c"), (2, 10, "d"), (3, 1, None)],
                               "k long, t long, x string")
    got = {r["k"]: (r["t"], r["x"]) for r in ordered.first_per_key(df, "k", "t").collect()}
    assert got == {1: (3, "a"), 2: (9, "c"), 3: (1, None)}
    last = {r["k"]: r["t"] for r in ordered.first_per_key(df, "k", "t", keep="last").collect()}
    assert last == {1: 5, 2: 10, 3: 1}


def test_split_windows_with_a_hot_null_key(spark):
    import random as _r
    rnd = _r.Random(4)
    rows = [(i, None if i % 3 == 0 else rnd.randint(1, 5), rnd.randint(0, 40), float(rnd.randint(0, 9)))
            for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k long, t long, v double")
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = (df.withColumn("nx", F.lead("v").over(w)).withColumn("rk", F.row_number().over(w) - 1)
           .withColumn("cs", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    a = ordered.next_within(df, "k", ["t", "id"], "v", "nx", min_hot_rows=10)
    a = ordered.rank_within(a, "k", ["t", "id"], "rk", min_hot_rows=10)
    a = ordered.running_sums(a, ["t", "id"], {"cs": "v"}, keys=["k"], min_hot_rows=10)
    j = ref.alias("r").join(a.alias("a"), "id")
    bad = j.where(~F.col("r.nx").eqNullSafe(F.col("a.nx")) | (F.col("r.rk") != F.col("a.rk"))
                  | (F.abs(F.col("r.cs") - F.col("a.cs")) > 1e-9))
    assert j.count() == 600 and bad.count() == 0


def test_hot_key_with_a_string_order_and_a_constant_first_order_column(spark):
    df = spark.createDataFrame([(1 if i % 4 else i, 5, f"t{(i * 37) % 400:04d}", i) for i in range(400)],
                               "k long, fixed long, t string, id long")
    ranged, split = ordered._bucketed(df, ["k"], ["fixed", "t"], 10)
    assert split and ranged.where("k = 1").select(ordered._SUB).distinct().count() >= 4
    w = Window.partitionBy("k").orderBy("fixed", "t")
    ref = df.select("id", (F.row_number().over(w) - 1).alias("rk"), F.lead("id").over(w).alias("nx"))
    got = ordered.next_within(ordered.rank_within(df, "k", ["fixed", "t"], "rk", min_hot_rows=10), "k", ["fixed", "t"],
                              "id", "nx", min_hot_rows=10).select("id", "rk", "nx")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)
