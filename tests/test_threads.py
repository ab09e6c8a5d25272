"""Fits from threads of their own, which have no active session."""

from pyspark.sql import functions as F

from riskframe.operators import models as MD


def test_forests_are_pruned_in_threads_without_an_active_session(spark):
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 20 > 12).cast("int").alias("target"),
                                 F.lit(1.0).alias("weight"))
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    oob = MD.oob_forest(df, "k", 4, maxDepth=3, min_samples_split=10, min_samples_leaf=1)
    assert oob.agg(F.avg(((F.col("score") >= 0.5) == (F.col("target") == 1)).cast("int"))).first()[0] > 0.95
