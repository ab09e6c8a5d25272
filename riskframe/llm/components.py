"""Connected components of a links table by alternating large and small stars, round by round on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import common


def stars(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: comparable, not null) that is not the smallest of its component.

    A round joins each link with the least neighbour of its node, found by a grouped minimum, so that no node's
    neighbours are ever gathered in one place; rounds grow with the logarithm of the nodes.
    """
    few = common.fewer
    edges = common.saved(few(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), "links")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
        both = edges.union(edges.select("b", "a"))
        least = few(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
        large = few(few(both.join(least, "a")).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = few(large.groupBy("a").agg(F.min("b").alias("m")))
        small = few(large.join(least, "a")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        edges = common.saved(few(small.distinct()), "links")
