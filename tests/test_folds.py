"""Folds by ranges of the hash."""

from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskframe.functions.core import hash_order
from riskframe.operators import features as FE
from riskframe.operators import ordered


def _rows(spark, n=6000):
    # one class holds nearly all; some keys are null
    return spark.range(n).select(F.when(F.col("id") % 997 != 3, F.col("id")).alias("id"), (F.col("id") % 100 == 0).cast("int").alias("y"),
                                 (F.col("id") % 7).alias("v"))


def _expected(df, label, seed, k):
    w = Window.partitionBy(*label).orderBy(hash_order(seed, F.col("id")), "id")
    return {(r["id"], r["y"]): r["f"] for r in df.where("id IS NOT NULL").unionByName(df.where("id IS NULL"))
            .withColumn("f", ((F.row_number().over(w) - 1) % k).cast("int")).where("id IS NOT NULL").collect()}


def test_folds_of_one_large_class_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 50)
    df = _rows(spark)
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(merged)
    spark.conf.set(merged, "false")
    got = FE.stratified_folds(df, "y", "id", 5)
    assert got.columns == [*df.columns, "fold"]
    rows = got.withColumn("p", F.spark_partition_id()).collect()
    assert {(r["id"], r["y"]): r["fold"] for r in rows if r["id"] is not None} == _expected(df, ["y"], FE.SEED, 5)
    assert len(rows) == 6000 and len(set(r["id"] for r in rows)) == df.select("id").distinct().count()
    most = max(Counter(r["p"] for r in rows).values())
    spark.conf.set(merged, was)
    assert most < 3000                                          # the large class has 5,940 rows


def test_folds_by_several_columns(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 50)
    df = _rows(spark).where("id IS NOT NULL")
    got = FE.stratified_folds(df, ["y", "v"], "id", 3, seed=9)
    assert {(r["id"], r["y"]): r["fold"] for r in got.collect()} == _expected(df, ["y", "v"], 9, 3)


def test_fold_sets_are_the_folds_of_every_seed(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 200)
    df = _rows(spark, 1500).where("id IS NOT NULL")
    seeds = list(range(1000, 1030))                             # more than a long holds digits
    got = {r["id"]: r["folds"] for r in FE.stratified_fold_sets(df, "y", "id", 5, seeds).collect()}
    assert len(got) == df.count()
    for i in (0, 1, 26, 27, 29):
        assert {k: v[i] for k, v in got.items()} == {k: v for (k, _), v in _expected(df, ["y"], seeds[i], 5).items()}
