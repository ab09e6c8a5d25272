"""Line totals by one exchange, hot orders apart; small tables over all cores."""

from pyspark.sql import functions as F

from riskframe.plans.enc import line_totals
from riskframe.session import spread


def _lines(spark, hot):
    i = F.col("id")
    order = F.when(i % 50 == 7, None).when((i % 2 == 0) & F.lit(hot), F.lit(1)).otherwise(i % 400)
    return spark.range(4000).select(order.cast("bigint").alias("l_orderkey"), F.when(i % 13 != 0, i % 37).alias("l_suppkey"), (i % 91).alias("l_partkey"),
                                    F.when(i % 11 != 0, i % 5).alias("l_quantity"), F.when(i % 3 == 0, "R").when(i % 3 == 1, "N").alias("l_returnflag"))


def _plain(df):
    return df.where("l_orderkey IS NOT NULL").groupBy("l_orderkey").agg(
        F.count(F.lit(1)), F.sum("l_quantity"), F.count_if(F.col("l_returnflag") == "R"), F.count_distinct("l_suppkey"), F.min("l_partkey"), F.min("l_suppkey"))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_line_totals_move_lines_once(spark):
    df = _lines(spark, False)
    got = line_totals(df)
    assert got._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
    assert _rows(got) == _rows(_plain(df))


def test_line_totals_of_a_hot_order(spark):
    df = _lines(spark, True)
    assert _rows(line_totals(df)) == _rows(_plain(df))


def test_small_tables_are_spread_over_the_cores(spark):
    df = spark.range(1000).coalesce(1)
    got = spread(df)
    assert got.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r[0] for r in got.collect()) == list(range(1000))
