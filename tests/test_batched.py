"""Many logistic models in one batch against single fits, and metrics of many scorings against single ones."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskframe.operators import batched as B
from riskframe.operators import features as FE
from riskframe.operators import metrics as M
from riskframe.operators import models as MD
from riskframe.operators import ordered
from riskframe.operators import validate as V


@pytest.fixture(scope="module")
def table(spark):
    g = np.random.default_rng(11)
    x = g.normal(size=(600, 4))
    x[:, 3] = (x[:, 3] > 0.5)
    y = (g.random(600) < 1 / (1 + np.exp(-(x @ [1.2, -0.7, 0.0, 0.4] - 0.3)))).astype(int)
    rows = [(i, int(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "encounter_id long, target int, a double, b double, c double, d double")
    df = FE.balanced_weights(FE.stratified_folds(df, "target", "encounter_id", 3), "target")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).cache()


@pytest.mark.parametrize(("penalty", "C"), [("l2", 0.05), ("l2", 10.0), ("l1", 0.05), ("l1", 1.0)])
def test_fits_equal_single_fits(table, penalty, C):
    batch = B.Batch(table, B._folds(3, "fold"))
    fits = batch.fit([B.Fit(f"train{i}", C, penalty) for i in range(3)] + [B.Fit("test0", C, penalty)])
    for f, rows in zip(fits, [table.where(f"fold <> {i}") for i in range(3)] + [table.where("fold = 0")]):
        single = MD.logistic(C=C, penalty=penalty, tol=1e-13, max_iter=2000).fit(rows)
        assert np.allclose(f.coefficients, single.coefficients.toArray(), atol=2e-6)
        assert abs(f.intercept - single.intercept) < 2e-6
        assert f.residual < 1e-9 and f.steps < 30
        if penalty == "l1" and C == 0.05:
            assert (f.coefficients == 0).any()


def test_separable_and_empty(spark):
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(i, int(i > 4), float(i), 1.0) for i in range(10)], "encounter_id long, target int, x double, weight double"))
    batch = B.Batch(df, {"all": F.lit(1), "none": F.lit(0), "ones": (F.col("target") == 1).cast("int")})
    fit = batch.fit([B.Fit("all", 100.0, "l2")])[0]
    assert np.isfinite(fit.beta).all() and fit.coefficients[0] > 0
    with pytest.raises(ValueError, match="none"):
        batch.fit([B.Fit("none")])
    assert batch.metrics([fit], ["ones"])[0]["roc_auc"] is None
    assert batch.metrics([fit], ["none"]) == [{}]


@pytest.mark.parametrize("hot", [None, 5])
def test_grouped_metrics(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(ordered, "MIN_HOT_ROWS", hot)
    g = np.random.default_rng(5)
    rows = [(int(k), int(g.random() < 0.4), float(round(g.random(), 2)), float(g.integers(1, 4))) for k in g.choice([0, 0, 0, 1, 2], 400)]
    df = spark.createDataFrame([*rows, (7, 1, 0.5, 1.0), (7, 1, None, 1.0)], "k int, label int, score double, w double")
    for weight in (None, "w"):
        found = {r["k"]: r for r in M.grouped_metrics(df, ["k"], weight=weight).collect()}
        for k in (0, 1, 2):
            part = df.where(f"k = {k}")
            assert abs(found[k]["roc_auc"] - M.roc_auc(part, weight=weight).first()[0]) < 1e-12
            assert abs(found[k]["average_precision"] - M.average_precision(part, weight=weight).first()[0]) < 1e-12
            if weight is None:
                one = M.classification_metrics(part, digits=12).first()
                assert all(abs(found[k][m] - one[m]) < 1e-9 for m in ("accuracy", "precision", "recall", "f1"))
        assert found[7]["roc_auc"] is None and found[7]["average_precision"] == 1.0
    assert M.grouped_metrics(df.where("false"), ["k"]).count() == 0


def test_protocols_equal_single_ones(table):
    grid = [{"C": 0.1, "penalty": "l2"}, {"C": 1.0, "penalty": "l1"}]
    one = {r["candidate"]: r for r in MD.search_cv(table, lambda p: MD.logistic(tol=1e-12, **p), grid, 3).collect()}
    for r in B.search_logistic(table, grid, 3).collect():
        assert np.allclose(r["split_test_scores"], one[r["candidate"]]["split_test_scores"], atol=1e-4)
        assert np.allclose(r["split_train_scores"], one[r["candidate"]]["split_train_scores"], atol=1e-4)
        assert r["rank_test_score"] == one[r["candidate"]]["rank_test_score"]
    a = V.bootstrap_models(table, lambda w: MD.logistic(weight=w, tol=1e-12), 3).orderBy("replicate").collect()
    b = B.bootstrap_logistic(table, 3).orderBy("replicate").collect()
    assert np.allclose([x[1:] for x in a], [x[1:] for x in b], atol=1e-4)
    a = V.learning_curve(table, lambda: MD.logistic(tol=1e-12), [0.5], 3).orderBy("fraction", "metric").collect()
    b = B.learning_curve_logistic(table, [0.5], 3).orderBy("fraction", "metric").collect()
    assert np.allclose([x[2:] for x in a], [x[2:] for x in b], atol=1e-4)
    a = V.stability(table, lambda: MD.logistic(tol=1e-12), 1, 3)[0].orderBy("run", "fold").collect()
    scores, coefficients = B.stability_logistic(table, 1, 3)
    assert np.allclose([x[2] for x in a], [x[2] for x in scores.orderBy("run", "fold").collect()], atol=1e-4)
    assert len(coefficients) == 3
    a = V.nested_cv(table, lambda p: MD.logistic(tol=1e-12, **p), grid, 2, 2).orderBy("outer_fold").collect()
    b = B.nested_logistic(table, grid, 2, 2).orderBy("outer_fold").collect()
    assert [x["best_params"] for x in a] == [x["best_params"] for x in b]
    assert np.allclose([x[2:] for x in a], [x[2:] for x in b], atol=1e-4)


def test_pruned_forest(spark, table):
    """Under min_samples_split no node of fewer rows is split; the rest of the forest is as it was."""
    from pyspark.ml.functions import vector_to_array
    from riskframe.session import scratch_path
    kw = {"numTrees": 5, "maxDepth": 8, "min_samples_leaf": 2, "featureSubsetStrategy": "all"}
    full, cut = MD.forest(min_samples_split=2, **kw).fit(table), MD.forest(min_samples_split=60, **kw).fit(table)
    nodes = []
    for m in (full, cut):
        path = scratch_path(spark, "m")
        m.write().save(path)
        nodes.append([r.asDict() for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()])
    assert any(0 <= n["leftChild"] and n["rawCount"] < 60 for n in nodes[0])
    assert not any(0 <= n["leftChild"] and n["rawCount"] < 60 for n in nodes[1])
    kept = {(n["treeID"], n["rawCount"], n["prediction"]) for n in nodes[1]}
    assert kept <= {(n["treeID"], n["rawCount"], n["prediction"]) for n in nodes[0]} and cut.totalNumNodes == len(nodes[1])
    score = lambda m: [r[0] for r in m.transform(table).orderBy("encounter_id").select(vector_to_array("probability")[1]).collect()]
    same = MD.prune_small_splits(full, 1)
    assert score(same) == score(full) and score(cut) != score(full)
    by = {}
    for n in nodes[1]:
        by.setdefault(n["treeID"], {})[n["id"]] = n
    rows = table.orderBy("encounter_id").select("features").collect()
    walked = []
    for r in rows:
        votes = 0.0
        for tree in by.values():
            n = tree[0]
            while n["leftChild"] >= 0:
                s = n["split"]
                n = tree[n["leftChild"] if r["features"][s["featureIndex"]] <= s["leftCategoriesOrThreshold"][0] else n["rightChild"]]
            votes += n["impurityStats"][1] / sum(n["impurityStats"])
        walked.append(votes / len(by))
    assert np.allclose(walked, score(cut))


def _flat_problem():
    """Slope, Hessian and start of a lasso whose third column is the sum of the first two: a flat direction, small penalty."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2)) * [1.0, 3.0]
    x = np.column_stack([x, x.sum(axis=1), rng.normal(size=500), np.ones(500)])
    x[:, 2] /= x[:, 2].std()
    y = x @ [0.5, -0.2, 0.4, 0.0, 0.3] + rng.normal(size=500)
    return -x.T @ y, x.T @ x


@pytest.mark.parametrize("lam", [0.01, 1.0, 200.0, 1e6])
@pytest.mark.parametrize("start", [[0.0] * 5, [0.4, -0.3, 0.9, 1.0, 0.0], [-5.0, 5.0, -5.0, 0.0, 2.0]])
def test_lasso_step_is_exact_where_columns_are_collinear(lam, start):
    g0, h = _flat_problem()
    b = np.array(start)
    u = b + B._lasso_step(g0 + h @ b, h, b, lam)
    slope = g0 + h @ u
    off = np.where(u != 0, np.abs(slope + lam * np.sign(u)), np.maximum(np.abs(slope) - lam, 0))
    off[-1] = abs(slope[-1])
    assert off.max() < 1e-8 * max(1.0, lam)
    assert (u[:3] == 0).any()                               # of collinear columns, one is left out
