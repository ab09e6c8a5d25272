"""Validation protocols (V2-V9).

Every protocol works on one table that already carries a fold column (V1)
and, where needed, hash-derived weights; a "fit" is a distributed pyspark.ml
job, and every metric of a fold comes from one scored frame (one fit per
fold for all metrics -- the reference refits once per metric).
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.core import poisson1, qcol, uniform
from riskframe.operators import metrics as M
from riskframe.operators.explore import stability_grade
from riskframe.operators.features import stratified_folds
from riskframe.operators.models import parallel_map, predict
from riskframe.session import cut_lineage

# --- fixed values --------------------------------------------------------------
CV_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]
STABILITY_CV_HIGH, STABILITY_CV_MED = 0.05, 0.10
SPREAD_LOW, SPREAD_MED = 0.05, 0.10
OVERFIT_LOW, OVERFIT_MED = 0.05, 0.15
CV_FOLDS, NESTED_OUTER, NESTED_INNER = 10, 3, 3
BOOTSTRAP_REPLICATES, STABILITY_RUNS, STABILITY_FOLDS = 100, 20, 5
CURVE_SIZES, CURVE_FOLDS = [round(0.1 * i, 1) for i in range(1, 11)], 5
BOOT_LOW_PCT, BOOT_HIGH_PCT = 2.5, 97.5
# --------------------------------------------------------------------------------


def fold_metrics(scored: DataFrame, label: str = "target", threshold: float = 0.5) -> dict[str, float]:
    """All CV metrics from one scored frame (two small aggregates)."""
    cm = M.classification_metrics(scored, label, "score", threshold).first()
    auc = M.roc_auc(scored, label, "score").first()[0]
    return {"accuracy": cm["accuracy"], "precision": cm["precision"], "recall": cm["recall"], "f1": cm["f1"],
            "roc_auc": auc}


# V2 / V3 / V4 ----------------------------------------------------------------------
def cross_validate(df: DataFrame, make_estimator: Callable, k: int = CV_FOLDS, label: str = "target", fold: str = "fold",
                   with_train: bool = False, threshold: float = 0.5) -> DataFrame:
    """Per (fold, side, metric) values, one fit per fold and one curve for all folds and sides; the seconds of a fit and of
    writing its scores are metrics fit_time and score_time of side 'time'."""
    spark = df.sparkSession

    def one(i):
        tr, te = df.where(F.col(fold) != i), df.where(F.col(fold) == i)
        t0 = time.time()
        m = make_estimator().fit(tr)
        t1 = time.time()
        sides = [("test", te)] + ([("train", tr)] if with_train else [])
        scored = cut_lineage(reduce(DataFrame.unionByName, [predict(m, part, keep=[label]).select(
            F.lit(i).alias("fold"), F.lit(side).alias("side"), F.col(label), "score") for side, part in sides]))
        return scored, [(i, "time", "fit_time", t1 - t0), (i, "time", "score_time", time.time() - t1)]
    done = parallel_map(one, list(range(k)))
    graded = M.grouped_metrics(reduce(DataFrame.unionByName, [d[0] for d in done]), ["fold", "side"], label, "score", threshold=threshold)
    long = graded.select("fold", "side", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in CV_METRICS])).alias("_m"))
    times = spark.createDataFrame([r for d in done for r in d[1]], "fold int, side string, metric string, value double")
    return cut_lineage(long.select("fold", "side", "_m.*").unionByName(times))


def summarize_cv(per_fold: DataFrame) -> DataFrame:
    """mean, population std, min, max per (side, metric); stability = std / mean."""
    g = per_fold.groupBy("side", "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                               F.min("value").alias("min"), F.max("value").alias("max"))
    return g.withColumn("stability", F.try_divide(F.col("std"), F.col("mean")))


def overfitting(summary: DataFrame) -> DataFrame:
    """train mean - test mean per metric (V4)."""
    return summary.groupBy("metric").agg(
        (F.max(F.when(F.col("side") == "train", F.col("mean"))) - F.max(F.when(F.col("side") == "test", F.col("mean"))))
        .alias("gap"))


# V5 -------------------------------------------------------------------------------
def nested_cv(df: DataFrame, make_estimator: Callable, grid: Sequence[dict], outer_k: int = NESTED_OUTER,
              inner_k: int = NESTED_INNER, label: str = "target", fold: str = "fold", key: str = "encounter_id",
              seed: int = 7) -> DataFrame:
    """Outer folds from ``fold``; inside each outer-train part a fresh stratified inner fold column, a search over
    ``grid`` by mean inner AUC (the first best wins ties), refit, and the outer-test AUC. Rows per outer fold."""
    rows = []
    for o in range(outer_k):
        tr, te = df.where(F.col(fold) != o), df.where(F.col(fold) == o)
        inner = cut_lineage(stratified_folds(tr.drop(fold), label, key, inner_k, seed=seed + o, name="_inner"))

        def inner_auc(job):
            params, i = job
            m = make_estimator(params).fit(inner.where(F.col("_inner") != i))
            s = predict(m, inner.where(F.col("_inner") == i), keep=[label])
            return M.roc_auc(s, label, "score").first()[0]
        aucs = parallel_map(inner_auc, [(params, i) for params in grid for i in range(inner_k)])
        means = [sum(aucs[g * inner_k:(g + 1) * inner_k]) / inner_k for g in range(len(grid))]
        g = means.index(max(means))
        m = make_estimator(grid[g]).fit(tr)
        outer_auc = M.roc_auc(predict(m, te, keep=[label]), label, "score").first()[0]
        rows.append((o, json.dumps(grid[g], sort_keys=True), float(means[g]), float(outer_auc)))
    return df.sparkSession.createDataFrame(rows, "outer_fold int, best_params string, inner_auc double, outer_auc double")


def nested_summary(nested: DataFrame) -> DataFrame:
    """mean, std, 95% CI = mean +- 1.96 std / sqrt(k); frequency of each chosen parameter set."""
    s = nested.agg(F.avg("outer_auc").alias("mean"), F.stddev_pop("outer_auc").alias("std"),
                   F.count(F.lit(1)).alias("k"))
    s = s.withColumn("ci_low", F.col("mean") - 1.96 * F.col("std") / F.sqrt("k")) \
        .withColumn("ci_high", F.col("mean") + 1.96 * F.col("std") / F.sqrt("k"))
    freq = nested.groupBy("best_params").agg(F.count(F.lit(1)).alias("times"))
    return s, freq


# V6 -------------------------------------------------------------------------------
def bootstrap_weights(df: DataFrame, key: str, replicate: int, seed: int = 42, name: str = "bw") -> DataFrame:
    """Poisson(1) weight per row for replicate ``replicate`` (hash-derived; in-bag iff weight > 0)."""
    return df.withColumn(name, poisson1(uniform(f"{seed}:{replicate}", qcol(key))).cast("double"))


def bootstrap_models(df: DataFrame, make_estimator: Callable, replicates: int = BOOTSTRAP_REPLICATES,
                     key: str = "encounter_id", label: str = "target", seed: int = 42) -> DataFrame:
    """Fit on in-bag rows with Poisson weights (times the row weights, if any), evaluate out of bag: rows (replicate,
    accuracy, precision, recall, f1, roc_auc)."""
    def one(b):
        w = bootstrap_weights(df, key, b, seed)
        weight = F.col("bw") * F.col("weight") if "weight" in df.columns else F.col("bw")
        m = make_estimator("bw").fit(w.where(F.col("bw") > 0).withColumn("bw", weight))
        values = fold_metrics(predict(m, w.where(F.col("bw") == 0), keep=[label]), label)
        return (b, *[float(values[c]) for c in CV_METRICS])
    return df.sparkSession.createDataFrame(parallel_map(one, range(replicates)),
                                           "replicate int, " + ", ".join(f"{c} double" for c in CV_METRICS))


def metric_bootstrap(scored: DataFrame, key: str, replicates: int, label: str = "label", score: str = "score",
                     threshold: float = 0.5, seed: int = 42) -> DataFrame:
    """Weighted accuracy / precision / recall of a fixed score under ``replicates`` Poisson resamples,
    all replicates in ONE aggregate pass (no row copies): rows (replicate, accuracy, precision, recall)."""
    y = qcol(label) == 1
    p = qcol(score) >= threshold
    aggs = []
    for b in range(replicates):
        w = poisson1(uniform(f"{seed}:{b}", qcol(key))).cast("double")
        aggs += [F.sum(w).alias(f"n{b}"), F.sum(F.when(y == p, w).otherwise(0.0)).alias(f"c{b}"),
                 F.sum(F.when(y & p, w).otherwise(0.0)).alias(f"tp{b}"),
                 F.sum(F.when(p, w).otherwise(0.0)).alias(f"pp{b}"), F.sum(F.when(y, w).otherwise(0.0)).alias(f"ap{b}")]
    a = scored.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(b).alias("replicate"),
                             F.try_divide(F.col(f"c{b}"), F.col(f"n{b}")).alias("accuracy"),
                             F.coalesce(F.try_divide(F.col(f"tp{b}"), F.col(f"pp{b}")), F.lit(0.0)).alias("precision"),
                             F.coalesce(F.try_divide(F.col(f"tp{b}"), F.col(f"ap{b}")), F.lit(0.0)).alias("recall"))
                    for b in range(replicates)])
    return a.select(F.explode(arr).alias("_s")).select("_s.*")


def bootstrap_summary(reps: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per metric: mean, population std, median, 2.5 and 97.5 percentiles (linear)."""
    from riskframe.operators.quantiles import quantiles_wide
    stats = reps.agg(*[F.avg(m).alias(f"_m{i}") for i, m in enumerate(metrics)],
                     *[F.stddev_pop(m).alias(f"_s{i}") for i, m in enumerate(metrics)])
    arr = F.array(*[F.struct(F.lit(m).alias("column"), F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("std"))
                    for i, m in enumerate(metrics)])
    s = stats.select(F.explode(arr).alias("_s")).select("_s.*")
    q = quantiles_wide(reps, metrics, [0.5, BOOT_LOW_PCT / 100, BOOT_HIGH_PCT / 100], ["median", "p2_5", "p97_5"])
    return s.join(q, "column").withColumnRenamed("column", "metric")


# V7 -------------------------------------------------------------------------------
def learning_curve(df: DataFrame, make_estimator: Callable, fractions: Sequence[float] = CURVE_SIZES, k: int = CURVE_FOLDS,
                   key: str = "encounter_id", label: str = "target", fold: str = "fold", seed: int = 42) -> DataFrame:
    """Train on a hash-chosen fraction of each training fold: per (fraction, metric) mean and std over the folds of the
    training and the validation value, for all CV metrics, and their gap."""
    u = uniform(f"lc{seed}", qcol(key))

    def one(job):
        frac, i = job
        tr, te = df.where((F.col(fold) != i) & (u <= frac)), df.where(F.col(fold) == i)
        m = make_estimator().fit(tr)
        a, b = (fold_metrics(predict(m, part, keep=[label]), label) for part in (tr, te))
        return [(float(frac), i, c, float(a[c]), float(b[c])) for c in CV_METRICS]
    rows = [r for part in parallel_map(one, [(f, i) for f in fractions for i in range(k)]) for r in part]
    res = df.sparkSession.createDataFrame(rows, "fraction double, fold int, metric string, train double, val double")
    return res.groupBy("fraction", "metric").agg(F.avg("train").alias("train_mean"), F.stddev_pop("train").alias("train_std"),
                                                 F.avg("val").alias("val_mean"), F.stddev_pop("val").alias("val_std")) \
        .withColumn("gap", F.col("train_mean") - F.col("val_mean"))


# V8 -------------------------------------------------------------------------------
def stability(df: DataFrame, make_estimator: Callable, runs: int = STABILITY_RUNS, k: int = STABILITY_FOLDS,
              key: str = "encounter_id", label: str = "target", importance: Callable | None = None
              ) -> tuple[DataFrame, DataFrame | None]:
    """``runs`` reseeded k-fold CVs: AUC per (run, fold); with ``importance(model) -> {feature: value}`` also, per
    feature, mean and std over all fits and its place by std (1: the steadiest)."""
    spark = df.sparkSession
    folds = [cut_lineage(stratified_folds(df, label, key, k, seed=1000 + r, name="_sf")) for r in range(runs)]

    def one(job):
        r, i = job
        m = make_estimator().fit(folds[r].where(F.col("_sf") != i))
        auc = M.roc_auc(predict(m, folds[r].where(F.col("_sf") == i), keep=[label]), label, "score").first()[0]
        return (r, i, float(auc)), [(f, float(v)) for f, v in importance(m).items()] if importance else []
    done = parallel_map(one, [(r, i) for r in range(runs) for i in range(k)])
    scores = spark.createDataFrame([d[0] for d in done], "run int, fold int, roc_auc double")
    if importance is None:
        return scores, None
    return scores, importance_steadiness(spark, [x for d in done for x in d[1]])


def importance_steadiness(spark, values: Sequence[tuple[str, float]]) -> DataFrame:
    """Per feature: mean and std of its importance over all fits and its place by std (1: the steadiest)."""
    long = spark.createDataFrame(values, "feature string, value double")
    steady = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return steady.withColumn("stability_rank", F.row_number().over(Window.orderBy("std", "feature")))   # one row a feature


def stability_summary(runs: DataFrame) -> DataFrame:
    return runs.agg(F.avg("roc_auc").alias("mean"), F.stddev_pop("roc_auc").alias("std"),
                    F.min("roc_auc").alias("min"), F.max("roc_auc").alias("max")) \
        .withColumn("cv", F.try_divide(F.col("std"), F.col("mean"))).withColumn("grade", stability_grade(F.col("cv")))


# V9 -------------------------------------------------------------------------------
def verdicts(summary: DataFrame) -> DataFrame:
    """Verdict rows from a CV summary: stability grade by CV, spread by std, risk of overfitting by the gap between the
    training and the test mean (null where the summary has no training side)."""
    cv, std, gap = F.col("stability"), F.col("std"), F.col("gap")
    rows = summary.where(F.col("side") == "test").join(overfitting(summary), "metric", "left")
    return rows.select(
        "metric", "mean", "std", F.when(cv < STABILITY_CV_HIGH, "high").when(cv < STABILITY_CV_MED, "medium")
        .otherwise("low").alias("stability_verdict"),
        F.when(std < SPREAD_LOW, "consistent").when(std < SPREAD_MED, "moderately variable").otherwise("highly variable")
        .alias("spread_verdict"),
        F.when(gap < OVERFIT_LOW, "low").when(gap < OVERFIT_MED, "moderate").when(gap.isNotNull(), "high").alias("overfit_verdict"))
