"""Blocks of co-moments against Spark's pairwise aggregates, and their merges."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskframe.operators import blocks, explore
from riskframe.operators import select as X


@pytest.fixture(scope="module")
def wide(spark):
    """200 columns, some with nulls, one constant, one far from zero."""
    g = np.random.default_rng(2)
    x = g.normal(size=(300, 200)) @ (np.eye(200) + 0.1 * g.normal(size=(200, 200)))
    x[:, 7] = 3.0
    x[:, 9] += 1e6
    rows = [[None if j % 5 == 0 and (i * 7 + j) % 11 == 0 else float(v) for j, v in enumerate(r)] for i, r in enumerate(x)]
    return spark.createDataFrame(rows, ", ".join(f"c{j} double" for j in range(200))).repartition(7)


def test_two_hundred_columns(wide):
    cols = [f"c{j}" for j in range(200)]
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in explore.correlation_matrix(wide, cols).collect()}
    assert len(got) == 40_000 and got["c7", "c1"] is None and got["c7", "c7"] is None
    some = [(a, b) for a in ("c0", "c5", "c9", "c33") for b in ("c1", "c5", "c10", "c199")]
    want = wide.agg(*[F.corr(a, b).alias(f"{a}_{b}") for a, b in some]).first()
    for a, b in some:
        assert got[a, b] == pytest.approx(want[f"{a}_{b}"], abs=1e-9) and got[a, b] == pytest.approx(got[b, a], abs=1e-12)


def test_merge_is_the_whole(monkeypatch):
    g = np.random.default_rng(4)
    x, present = g.normal(size=(90, 5)) + 1e6, g.random((90, 5)) < 0.8
    present[:30, 2] = False
    whole = blocks._of(x, present)
    parts = [blocks._of(x[a:a + 30], present[a:a + 30]) for a in (0, 30, 60)]
    both = blocks._merged(blocks._merged(parts[0], parts[1]), blocks._merged(np.zeros((4, 5, 5)), parts[2]))
    assert np.allclose(whole, both, rtol=1e-9, atol=1e-6)


def test_two_step_merge_vectors_and_vif(spark, monkeypatch):
    g = np.random.default_rng(6)
    rows = [tuple(map(float, (a, b, a + b + c))) for a, b, c in g.normal(size=(200, 3))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    one = {r["feature"]: r["vif"] for r in X.vif(df, ["a", "b", "c"]).collect()}
    monkeypatch.setattr(blocks, "MERGE_AT_ONCE", 2)
    two = {r["feature"]: r["vif"] for r in X.vif(v, vector="features").collect()}
    assert one == pytest.approx(two, rel=1e-9) and set(two) == {"a", "b", "c"}
    monkeypatch.setattr(blocks, "MAX_COLUMNS", 2)
    with pytest.raises(ValueError, match="3 columns"):
        X.vif(v, vector="features")


def test_nothing(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert {r["corr"] for r in explore.correlation_matrix(df, ["a", "b"]).collect()} == {None}
    assert {r["vif"] for r in X.vif(df, ["a", "b"]).collect()} == {float("inf")}
