"""Model fitting, scoring and persistence (L1-L9, S11, S12) on pyspark.ml.

Models are fitted on one cached vector table; sample weights (balanced class
weights, bootstrap weights) go through ``weightCol`` instead of copying rows.
Scores come back as a plain ``score`` column (probability of class 1) so the
relational metrics in :mod:`riskframe.operators.metrics` apply unchanged.
"""

from __future__ import annotations

import itertools
import json
import math
import re
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
# Logistic: the reference's C grid and penalties; forest: its default and grid.
LR_C_GRID = [0.001, 0.01, 0.1, 1, 10, 100]
LR_PENALTIES = ["l1", "l2"]
LR_MAX_ITER = 1000
SEARCH_CANDIDATES, SEARCH_FOLDS = 50, 5
RF_DEFAULT = {"numTrees": 300, "maxDepth": 15, "min_samples_split": 10, "min_samples_leaf": 4,
              "featureSubsetStrategy": "sqrt"}
RF_GRID = {"numTrees": [100, 200, 300], "maxDepth": [10, 15, 20, None], "min_samples_split": [5, 10, 15],
           "min_samples_leaf": [2, 4, 6], "featureSubsetStrategy": ["sqrt", "log2", "all"]}
SPARK_MAX_DEPTH = 30
PRESETS = {
    "fast": {"numTrees": 50, "maxDepth": 8, "min_samples_split": 10, "min_samples_leaf": 4,
             "featureSubsetStrategy": "sqrt"},
    "default": RF_DEFAULT,
}
# --------------------------------------------------------------------------------


PARALLELISM = 4


def parallel_map(fn: Callable, items: Sequence, parallelism: int = PARALLELISM) -> list:
    """Run independent fits concurrently (Spark schedules the jobs of several driver threads at once);
    results keep the order of ``items``."""
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as ex:
        return list(ex.map(fn, items))


# L1 -------------------------------------------------------------------------------
class Logistic(Estimator):
    """Logistic regression with an sklearn-style C: regParam = 1 / (C * sum of the weights), the sum taken over the very
    rows of each fit, so folds, fractions and bootstrap samples are penalised alike."""

    def __init__(self, features: str = "features", label: str = "target", weight: str | None = "weight", C: float = 1.0,
                 penalty: str = "l2", max_iter: int = LR_MAX_ITER, tol: float = 1e-6):
        super().__init__()
        self.weight, self.C = weight, C
        self.settings = dict(featuresCol=features, labelCol=label, maxIter=max_iter, tol=tol, standardization=False,
                             elasticNetParam=1.0 if penalty == "l1" else 0.0, probabilityCol="probability")
        if weight:
            self.settings["weightCol"] = weight

    def _fit(self, dataset: DataFrame):
        total = dataset.agg(F.sum(self.weight) if self.weight else F.count(F.lit(1))).first()[0]
        if not total:
            raise ValueError("no rows with a positive weight to fit on")
        return LogisticRegression(regParam=1.0 / (self.C * total), **self.settings).fit(dataset)


def logistic(**settings) -> Logistic:
    return Logistic(**settings)


# L3 -------------------------------------------------------------------------------
def prune_small_splits(model, min_rows: int, spark=None):
    """A fitted forest without splits of nodes of fewer than ``min_rows`` training rows: such a node becomes a leaf that
    predicts what its own rows say.

    The saved node table is read as rows: a child has no more rows than its parent, so a node stays if its parent (where it
    has one) has enough, and what stays is numbered anew inside its tree. As no split above depends on one below, this is
    the forest that would have grown under the limit. The tables are those of the model: trees x nodes.
    """
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.sql import SparkSession
    from riskframe.session import scratch_path
    spark = spark or SparkSession.active()               # a thread of its own has no active session: fits hand theirs over
    full, path = scratch_path(spark, "forest"), scratch_path(spark, "pruned-forest")
    model.write().save(full)
    n = spark.read.parquet(f"{full}/data").select("treeID", "nodeData.*")
    split = (F.col("leftChild") >= 0) & (F.col("rawCount") >= min_rows)
    child = n.where(split).select("treeID", F.explode(F.array("leftChild", "rightChild")).alias("id"))
    kept = n.join(child.withColumn("kept", F.lit(True)), ["treeID", "id"], "left").where((F.col("id") == 0) | F.col("kept"))
    kept = kept.withColumn("new", F.row_number().over(Window.partitionBy("treeID").orderBy("id")) - 1)      # a tree's nodes
    at = kept.select("treeID", F.col("id").alias("old"), "new")
    for side in ("left", "right"):
        kept = kept.join(at.select("treeID", F.col("old").alias(f"{side}Child"), F.col("new").alias(f"{side}New")), ["treeID", f"{side}Child"], "left")
    leaf = ~split
    node = F.struct(F.col("new").cast("int").alias("id"), "prediction", "impurity", "impurityStats", "rawCount",
                    F.when(leaf, -1.0).otherwise(F.col("gain")).alias("gain"),
                    *[F.when(leaf, -1).otherwise(F.col(f"{side}New")).cast("int").alias(f"{side}Child") for side in ("left", "right")],
                    F.when(leaf, F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
                                          F.lit(-1).alias("numCategories"))).otherwise(F.col("split")).alias("split"))
    kept.select("treeID", node.alias("nodeData")).write.parquet(f"{path}/data")
    spark.read.parquet(f"{full}/treesMetadata").write.parquet(f"{path}/treesMetadata")
    spark.read.text(f"{full}/metadata").coalesce(1).write.text(f"{path}/metadata")                           # one line
    return RandomForestClassificationModel.load(path)


class Forest(Estimator):
    """Random forest with sklearn's names: depth None -> Spark's max 30; min_samples_leaf -> minInstancesPerNode; splits of
    nodes with fewer than min_samples_split rows are pruned from the fitted forest."""

    def __init__(self, features: str = "features", label: str = "target", weight: str | None = "weight", seed: int = 42, **params):
        super().__init__()
        p = {**RF_DEFAULT, **params}
        depth = SPARK_MAX_DEPTH if p["maxDepth"] is None else min(int(p["maxDepth"]), SPARK_MAX_DEPTH)
        self.min_split, leaf = int(p["min_samples_split"]), int(p["min_samples_leaf"])
        # larger node batches = fewer passes over the data per tree level; node-id caching (checkpointed every
        # 10 iterations into the shared checkpoint folder) avoids re-deriving each row's node from the root
        self.settings = dict(featuresCol=features, labelCol=label, numTrees=int(p["numTrees"]), maxDepth=depth, minInstancesPerNode=leaf,
                             featureSubsetStrategy=str(p["featureSubsetStrategy"]), seed=seed, subsamplingRate=1.0, bootstrap=True,
                             maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10)
        if weight:
            self.settings["weightCol"] = weight
        self.settings.update(p.get("more", {}))
        self.may_prune = self.min_split > 2 * leaf           # a split has two children of ``leaf`` rows at least

    def _fit(self, dataset: DataFrame):
        from pyspark.ml.classification import RandomForestClassifier
        from riskframe.session import checkpoint_root
        checkpoint_root(dataset.sparkSession)
        model = RandomForestClassifier(**self.settings).fit(dataset)
        return prune_small_splits(model, self.min_split, dataset.sparkSession) if self.may_prune else model


def forest(**settings) -> Forest:
    return Forest(**settings)


# L5 / L6 --------------------------------------------------------------------------
def predict(model, df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """``score`` = P(class 1), ``pred`` = score >= threshold; plus the ``keep`` columns."""
    from pyspark.ml.functions import vector_to_array
    t = model.transform(df)
    s = vector_to_array(F.col("probability")).getItem(1)
    return t.select(*[F.col(f"`{k}`") for k in keep], s.alias("score"), (s >= threshold).cast("int").alias("pred"))


def score_new_rows(pipeline_model, df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """Score unseen rows with a fitted preprocessing+model ``PipelineModel`` (also works on a stream)."""
    return predict(pipeline_model, df, threshold, keep)


# attribute names of an assembled vector ---------------------------------------------
def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    meta = df.schema[features].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    if attrs:
        return [re.sub(r"__z$", "", a["name"].replace("__hot_", "_")) for a in sorted(attrs, key=lambda a: a["idx"])]
    n = meta.get("num_attrs", 0)
    return [f"f{i}" for i in range(n)]


# L7 / L8 --------------------------------------------------------------------------
def coefficient_importance(lr_model, names: Sequence[str], top: int | None = None):
    """Rows (feature, coefficient, abs_coefficient, rank) sorted by |coef| (ties by name)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    coefs = lr_model.coefficients.toArray().tolist()
    rows = sorted(zip(names, coefs), key=lambda t: (-abs(t[1]), t[0]))
    if top:
        rows = rows[:top]
    return spark.createDataFrame([(n, float(c), abs(float(c)), i + 1) for i, (n, c) in enumerate(rows)],
                                 "feature string, coefficient double, abs_coefficient double, rank int")


def impurity_importance(rf_model, names: Sequence[str]):
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = rf_model.featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(n, float(v), i + 1) for i, (n, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


# L2 -------------------------------------------------------------------------------
def lr_grid(C_values=LR_C_GRID, penalties=LR_PENALTIES) -> list[dict]:
    """Settings of :class:`Logistic` for every (C, penalty) pair."""
    return [{"C": C, "penalty": pen} for C, pen in itertools.product(C_values, penalties)]


# L4 -------------------------------------------------------------------------------
def sample_grid(grid: Mapping[str, Sequence], n: int = SEARCH_CANDIDATES, seed: int = 42) -> list[dict]:
    """``n`` distinct grid points chosen by a seeded hash of their description (reproducible)."""
    import hashlib
    keys = list(grid)
    pts = [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]
    pts.sort(key=lambda p: hashlib.md5(f"{seed}:{json.dumps(p, sort_keys=True)}".encode()).hexdigest())
    return pts[:n]


def search_cv(df: DataFrame, make_estimator: Callable, candidates: Sequence[dict], folds: int = SEARCH_FOLDS,
              label: str = "target", fold: str = "fold", parallelism: int = PARALLELISM) -> DataFrame:
    """Search results (L2 over a whole grid, L4 over a sample of one): a row per candidate with per-fold test and train
    AUC, means, stds, fit times and rank. Forests are grown together, every candidate a cut of the same trees
    (:mod:`riskframe.operators.forests`; the times are those of its trees, shared out evenly). Other estimators, and forests
    on tables too large for that, are fitted one by one: each (candidate, fold) is a distributed fit; several run at a time,
    each model scores the rows once.
    """
    from riskframe.operators import forests
    from riskframe.operators.metrics import grouped_metrics
    from riskframe.session import cut_lineage, scratch_path, spread
    df = spread(df.where(F.col(fold).isNotNull()))
    made = [make_estimator(params) for params in candidates]

    def one(job):
        est, k = job
        t0 = time.time()
        m = est.fit(df.where(F.col(fold) != k))
        t1 = time.time()
        scored = cut_lineage(predict(m, df, keep=[label, fold]).select((F.col(fold) == k).alias("_test"), label, "score"))
        auc = {r["_test"]: r["roc_auc"] for r in grouped_metrics(scored, ["_test"], label, "score").collect()}
        test, train = auc.get(True), auc.get(False)
        return float(test), float(train), t1 - t0, time.time() - t1
    scored = forests.scored_folds(df, made, folds, fold) if forests.together(made) else None
    if scored is None:
        done = parallel_map(one, [(e, k) for e in made for k in range(folds)], parallelism)
    else:
        path = scratch_path(df.sparkSession, "forest-scores")
        scored.write.parquet(path)
        scored = df.sparkSession.read.parquet(path)
        auc = {(r["candidate"], r["fold"], r["_test"]): r["roc_auc"]
               for r in grouped_metrics(scored, ["candidate", "fold", "_test"], "label", "score", "alike").collect()}
        spent = {(r["candidate"], r["fold"]): (r["f"], r["s"])
                 for r in scored.groupBy("candidate", "fold").agg(F.max("fit_s").alias("f"), F.max("score_s").alias("s")).collect()}
        done = [(float(auc.get((c, k, True))), float(auc.get((c, k, False))), *spent[c, k]) for c in range(len(made)) for k in range(folds)]
    rows = []
    for ci, params in enumerate(candidates):
        test_s, train_s, fit_t, score_t = ([r[i] for r in done[ci * folds:(ci + 1) * folds]] for i in range(4))
        rows.append((ci, json.dumps(params, sort_keys=True), _mean(fit_t), _std(fit_t), _mean(score_t), _std(score_t),
                     test_s, _mean(test_s), _std(test_s), train_s, _mean(train_s), _std(train_s)))
    return search_ranks(df.sparkSession, rows)


def search_ranks(spark, rows: list[tuple]) -> DataFrame:
    """The result table of a search, a row per candidate, with their ranks by mean test score."""
    res = spark.createDataFrame(
        rows, "candidate int, params string, mean_fit_time double, std_fit_time double, mean_score_time double, "
              "std_score_time double, split_test_scores array<double>, mean_test_score double, std_test_score double, "
              "split_train_scores array<double>, mean_train_score double, std_train_score double")
    w = Window.orderBy(F.desc("mean_test_score"), F.asc("candidate"))     # one row per candidate
    return res.withColumn("rank_test_score", F.rank().over(w))


def _mean(x):
    return sum(x) / len(x) if x else float("nan")


def _std(x):
    if not x:
        return float("nan")
    m = _mean(x)
    return math.sqrt(sum((v - m) ** 2 for v in x) / len(x))


# S11 / S12 ------------------------------------------------------------------------
def save_model(model, path: str, metadata: Mapping | None = None) -> None:
    """Persist a fitted (Pipeline)Model plus a one-row JSON metadata table beside it."""
    from pyspark.sql import SparkSession
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    meta = json.dumps(dict(metadata or {}), sort_keys=True, default=str)
    spark.createDataFrame([(meta,)], "metadata string").coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_model(path: str, kind: str = "pipeline"):
    from pyspark.sql import SparkSession
    if kind == "pipeline":
        from pyspark.ml import PipelineModel
        model = PipelineModel.load(f"{path}/model")
    else:
        from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
        model = (LogisticRegressionModel if kind == "logistic" else RandomForestClassificationModel).load(f"{path}/model")
    spark = SparkSession.getActiveSession()
    meta = spark.read.json(f"{path}/metadata").first()
    return model, json.loads(meta["metadata"]) if meta else {}


# L3 out-of-bag score (K10) ------------------------------------------------------------
def oob_forest(df: DataFrame, key: str, n_trees: int, features: str = "features", label: str = "target",
               weight: str | None = "weight", seed: int = 42, **params) -> DataFrame:
    """Out-of-bag predictions of a bagged forest built as ``n_trees`` single-tree fits.

    Spark's forest exposes no OOB rows, so each tree gets its own hash-derived Poisson(1) bag weights
    (in-bag rows train with that multiplicity, times the class weight); each row is then scored by the
    trees it was out of bag for and the votes are averaged. Rows: (key, label, score, oob_trees)."""
    from riskframe.functions.core import poisson1, uniform

    def one(b):
        bw = poisson1(uniform(f"oob{seed}:{b}", F.col(key))).cast("double")
        d = df.withColumn("_bag", bw).withColumn("_bw", F.col("_bag") * (F.col(weight) if weight else F.lit(1.0)))
        tree = Forest(features, label, "_bw", seed + b, **{**params, "numTrees": 1, "more": {"bootstrap": False}})
        m = tree.fit(d.where(F.col("_bag") > 0))
        return predict(m, d.where(F.col("_bag") == 0), keep=[key, label]).select(key, label, "score")
    preds = reduce(DataFrame.unionByName, parallel_map(one, range(n_trees)))
    return preds.groupBy(key, label).agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("oob_trees"))
