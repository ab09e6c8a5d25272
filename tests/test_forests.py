"""Forests of a search grown together: against Spark's own trees, and every candidate against a search of its own."""

import json

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from riskframe.operators import forests as FO
from riskframe.operators import models as MD

GRID = {"numTrees": [2, 4], "maxDepth": [3, None], "min_samples_split": [2, 20], "min_samples_leaf": [1, 5], "featureSubsetStrategy": ["sqrt", "log2", "all"]}


def _table(spark, n=400, by_class=True):
    """Two numeric columns (one of distinct values), a one-hot column of five levels, a 0/1 column and one of zeros."""
    g = np.random.default_rng(3)
    a, b, c, d = g.normal(size=n), g.integers(0, 6, n) * 0.5, g.integers(0, 5, n), g.random(n) < 0.3
    y = (g.random(n) < 1 / (1 + np.exp(-(a + (c == 2) - b)))).astype(int)
    w = np.where(y == 1, 1.5, 0.75) if by_class else g.integers(1, 5, n) / 2
    rows = [(int(y[i]), float(w[i]), i % 3, Vectors.dense([a[i], b[i], *(float(c[i] == k) for k in range(1, 5)), float(d[i]), 0.0])) for i in range(n)]
    return spark.createDataFrame(rows, ["target", "weight", "fold", "features"])


@pytest.mark.parametrize(("by_class", "depth", "leaf", "least"), [(True, 3, 1, 2), (False, 9, 1, 2), (True, 9, 6, 2), (True, 30, 2, 15)])
def test_tree_equals_sparks(spark, by_class, depth, leaf, least):
    """Every row drawn once and every feature tried: Spark's tree, its small splits pruned, row by row."""
    df = _table(spark, by_class=by_class)
    rows = FO.held_rows(df, "features", "target", "weight", "fold")
    assert rows.numeric == [0, 1] and sorted(map(len, rows.levels)) == [1, 5]           # zeros meet nothing
    b = FO.binned(rows, np.flatnonzero(rows.fold != 0))
    assert (b.scale is not None) == by_class
    tree = FO.grow(b, b.sums(rows.fold != 0), 8, [1, 2, 6], 30, 7)
    got = tree.cut(i := [1, 2, 6].index(leaf), np.array([2, depth]), np.array([40, least]))[tree.leaf[i][b.of], 1]
    model = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="all", weightCol="weight", labelCol="target",
                                   maxDepth=depth, minInstancesPerNode=leaf).fit(df.where("fold <> 0"))
    if least > 2 * leaf:
        model = MD.prune_small_splits(model, least, spark)
    want = {r[0]: r[1] for r in model.transform(df).select(vector_to_array("features")[0], vector_to_array("probability")[1]).collect()}
    assert len(want) == len(rows.y)                                                     # the first column tells rows apart
    assert np.allclose(got, [want[x] for x in rows.x[:, 0]], atol=1e-12)


def test_groups_are_split_alike(spark, monkeypatch):
    """Groups of one node, rows that lie otherwise: the same tree for every row."""
    df = _table(spark)
    rows = FO.held_rows(df, "features", "target", "weight", "fold")
    train, drawn = np.flatnonzero(rows.fold != 0), np.random.default_rng(1).poisson(1.0, len(rows.y)) * (rows.fold != 0)

    def scores(r):
        b = FO.binned(r, train)
        tree = FO.grow(b, b.sums(drawn), 3, [1, 4], 30, 7)
        return np.stack([tree.cut(i, np.array([4, 30]), np.array([2, 9]))[tree.leaf[i][b.of]] for i in (0, 1)])
    whole = scores(rows)
    monkeypatch.setattr(FO, "GROUP_NODES", 1)
    assert np.array_equal(scores(rows), whole)
    assert np.array_equal(scores(FO.held_rows(df.repartition(3), "features", "target", "weight", "fold")), whole)


def test_thresholds_and_layout():
    assert FO.thresholds(np.array([2.0, 1.0, 2.0, 4.0]), np.ones(4)).tolist() == [1.5, 3.0]
    v = np.arange(1000.0)
    assert len(cuts := FO.thresholds(v, np.ones(1000))) == 31 and abs(cuts[0] - 30.5) < 2
    assert FO.thresholds(v, np.where(v < 500, 9.0, 1.0))[15] < 300                       # by weight, not by rows
    both = np.array([[3, 0, 1], [0, 2, 0], [1, 0, 4]])
    assert FO._layout(both, np.zeros(3)) == ([], [[0, 1], [2]]) and FO._layout(both, np.array([0, 7, 0])) == ([1], [[0], [2]])


def test_candidates_score_alike_alone(spark):
    """Cuts of shared trees: a candidate's scores don't depend on the others of the search."""
    df = _table(spark)
    cands = MD.sample_grid(GRID, 12)
    res = {r["candidate"]: r for r in MD.search_cv(df, lambda p: MD.forest(**p), cands, 3).collect()}
    assert [json.loads(res[c]["params"]) for c in range(12)] == cands and sorted(r["rank_test_score"] for r in res.values())[0] == 1
    for c in (0, 7):
        alone = MD.search_cv(df, lambda p: MD.forest(**p), cands[c:c + 1], 3).first()
        assert alone["split_test_scores"] == res[c]["split_test_scores"] and alone["split_train_scores"] == res[c]["split_train_scores"]
    assert len({tuple(r["split_test_scores"]) for r in res.values()}) > 6


def test_too_large_to_hold(spark, monkeypatch):
    """Tables beyond a task's share are fitted one by one, with results of the same kind."""
    df, cands = _table(spark), [{"numTrees": 40, "maxDepth": 4, "min_samples_split": 2, "min_samples_leaf": 5, "featureSubsetStrategy": "all"}]
    held = MD.search_cv(df, lambda p: MD.forest(**p), cands, 2, fold="fold").first()
    monkeypatch.setattr(FO, "CELLS", 100)
    assert FO.held_rows(df, "features", "target", "weight", "fold") is None
    single = MD.search_cv(df, lambda p: MD.forest(**p), cands, 2, fold="fold").first()
    assert abs(held["mean_test_score"] - single["mean_test_score"]) < 0.05 and abs(held["mean_train_score"] - single["mean_train_score"]) < 0.05


def test_together():
    alike = [MD.forest(**p) for p in MD.sample_grid(MD.RF_GRID)]
    assert FO.together(alike)
    assert not FO.together([*alike, MD.forest(seed=1)]) and not FO.together([*alike, MD.logistic()])
    assert not FO.together([MD.forest(more={"bootstrap": False})]) and not FO.together([MD.forest(featureSubsetStrategy="onethird")])
