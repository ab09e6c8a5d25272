"""Joins with a hot id, distinct counts decided by sketches, and mutual information by nearest neighbours."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import explore, lookup, ordered
from riskframe.operators import select as X


def test_hot_id_is_joined_apart(spark):
    """One id in 40% of the rows: its rows are in the broadcast branch, the others are shuffled."""
    df = spark.range(5_000).select(F.when(F.col("id") % 10 < 4, 7).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 500 + 100).cast("int").alias("k"), F.col("id").alias("v"))
    dim = spark.range(600).select(F.lit("m").alias("mapping"), F.col("id").cast("int").alias("id"), F.concat(F.lit("d"), (F.col("id") % 31).cast("string")).alias("description"))
    assert lookup.hot_ids(df, "k", 0.1) == [7] and lookup.hot_ids(df.where("k <> 7"), "k", 0.1) == []
    got = lookup.apply_lookup(df, "k", dim, "m", name="t", max_rows=10)
    want = lookup.apply_lookup(df, "k", dim, "m", name="t")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = lookup.apply_lookup(df, "k", dim, "m", name="t", max_rows=10)._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert lookup.apply_lookup(df.where("false"), "k", dim, "m", name="t", max_rows=10).count() == 0
    hits = lookup.lookup_hit_counts(df, "k", dim, "m").first()
    assert (hits["rows"], hits["mapped"] + hits["unmapped"]) == (5_000, 5_000)
    assert hits["mapped"] == df.where("k is not null").count()


def test_distinct_above(spark, monkeypatch):
    df = spark.range(3_000).select(F.col("id").alias("all"), (F.col("id") % 50).alias("fifty"), (F.col("id") % 51).cast("string").alias("more"),
                                   F.lit(None).cast("int").alias("none"), (F.col("id") % 7).alias("few"))
    asked = []
    real = explore.distinct_counts
    monkeypatch.setattr(explore, "distinct_counts", lambda d, cols: asked.append(list(cols)) or real(d, cols))
    got = {r["column"]: (r["above"], r["exact"]) for r in explore.distinct_above(df, df.columns, threshold=50).collect()}
    assert got == {"all": (True, None), "fifty": (False, 50), "more": (True, 51), "none": (False, None), "few": (False, None)}
    assert asked == [["fifty", "more"]]
    ratio = {r["column"]: r["above"] for r in explore.distinct_above(df, df.columns, ratio=0.9).collect()}
    assert ratio == {"all": True, "fifty": False, "more": False, "none": False, "few": False}
    assert explore.distinct_above(df, [], threshold=3).count() == 0


def digamma(n):
    return -0.5772156649015329 + sum(1.0 / i for i in range(1, n))


def by_all_pairs(x, y, k):
    keep = [i for i in range(len(x)) if x[i] is not None and y.count(y[i]) > 1]
    x, y = [x[i] for i in keep], [y[i] for i in keep]
    size = {c: sum(1 for a in y if a == c) for c in set(y)}
    if any(n < 2 for n in size.values()):
        return None
    terms = []
    for i in range(len(x)):
        own = min(k, size[y[i]] - 1)
        r = sorted(abs(x[i] - x[j]) for j in range(len(x)) if j != i and y[j] == y[i])[own - 1]
        m = sum(abs(x[i] - v) < r if r > 0 else v == x[i] for v in x)
        terms.append(digamma(own) - digamma(size[y[i]]) - digamma(m))
    return max(0.0, digamma(len(x)) + sum(terms) / len(terms))


@pytest.mark.parametrize("split", [None, 20])
def test_neighbour_information(spark, monkeypatch, split):
    if split:
        monkeypatch.setattr(ordered, "MIN_HOT_ROWS", split)
    g = np.random.default_rng(8)
    y = [int(v) for v in g.integers(0, 3, 300)]
    cols = {"signal": [float(a) * 900 + float(g.integers(0, 1000)) for a in y], "ties": [float(g.integers(0, 4)) for _ in y],
            "wide": [float(g.integers(0, 10**6)) for _ in y], "holes": [None if i % 3 == 0 else float(g.integers(0, 50)) for i in range(300)]}
    df = spark.createDataFrame([(a, *r) for a, r in zip(y, zip(*cols.values()))], "target int, " + ", ".join(f"{c} double" for c in cols))
    got = {r["feature"]: r["mutual_info"] for r in X.neighbour_information(df, list(cols)).collect()}
    for c, x in cols.items():
        assert got[c] == pytest.approx(by_all_pairs(x, y, 3), abs=1e-9), c
    assert got["signal"] > 0.5 > got["wide"]


def test_neighbour_information_of_a_known_case(spark):
    """Two equally likely classes, uniform on [0, 2) and [1, 3): half of a row's label is known, ln 2 / 2 nats."""
    g = np.random.default_rng(1)
    y = g.integers(0, 2, 20_000)
    df = spark.createDataFrame([(int(a), float(a + 2 * u)) for a, u in zip(y, g.random(20_000))], "target int, x double")
    assert X.neighbour_information(df, ["x"]).first()["mutual_info"] == pytest.approx(math.log(2) / 2, abs=0.01)
    assert X.neighbour_information(df.where("false"), ["x"]).count() == 0
