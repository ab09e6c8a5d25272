"""Queries for models (L*), validation protocols (V*) and feature analysis (X*).

Model fits are checked by rows (no SQL can fit them); everything computed from
a fixed score column or as a closed-form aggregate has a SQL oracle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.core import hash_order_sql, poisson1, poisson1_sql, uniform, uniform_sql
from riskframe.operators import batched as B
from riskframe.operators import features as FE
from riskframe.operators import metrics as M
from riskframe.operators import models as MD
from riskframe.operators import select as X
from riskframe.operators import validate as V
from riskframe.plans.base import clean_enc, clean_sql, scored, scored_sql
from riskframe.plans.registry import register
from riskframe.session import cut_lineage

CAT = ["race", "gender", "age", "specialty"]
NUMF = ["num_lab", "num_med", "num_proc", "total_procedures", "long_stay", "medication_changed"]
H = hash_order_sql(42, "encounter_id")
RFE_MIN = 2                   # of the few numeric columns here; the operator's default is the reference's ten


def model_table(spark, sf):
    """Cleaned rows -> stratified split -> balanced weights and vector pipeline, both fitted on the training rows."""
    s = FE.stratified_split(clean_enc(spark, sf), "target", "encounter_id")
    s = cut_lineage(FE.balanced_weights(s, "target", split="split"))
    prep = FE.vector_pipeline(CAT, NUMF).fit(s.where("split = 'train'"))
    t = prep.transform(s).select("encounter_id", "target", "split", "weight", "features", *NUMF)
    # many fits read this table: cut the lineage once (reliable checkpoint in the shared checkpoint folder)
    return cut_lineage(t), prep


def _train_test(spark, sf):
    t, prep = model_table(spark, sf)
    return t.where("split = 'train'"), t.where("split = 'test'"), prep


def _train_folds(spark, sf, k):
    """Training rows in ``k`` balanced folds of their own."""
    return cut_lineage(FE.stratified_folds(_train_test(spark, sf)[0], "target", "encounter_id", k))


def _lr(**settings):
    return MD.logistic(**settings)


# L1 / L5
@register("l1_logistic_test_scores")
def l1(spark, sf):
    tr, te, _ = _train_test(spark, sf)
    m = _lr().fit(tr)
    return MD.predict(m, te, keep=["encounter_id", "target"])


@register("l1_logistic_test_metrics")
def l1m(spark, sf):
    tr, te, _ = _train_test(spark, sf)
    m = _lr().fit(tr)
    return M.all_metrics(MD.predict(m, te, keep=["target"]), "target", "score", 0.5)


# L3
@register("l3_forest_test_metrics")
def l3(spark, sf):
    tr, te, _ = _train_test(spark, sf)
    m = MD.forest(**MD.PRESETS["fast"]).fit(tr)
    return M.all_metrics(MD.predict(m, te, keep=["target"]), "target", "score", 0.5)


# Persist the fitted preprocessing + model pipeline, reload, score unseen rows
@register("l6_score_new_rows")
def l6(spark, sf):
    from pyspark.ml import Pipeline
    from riskframe.session import scratch_path
    s = FE.balanced_weights(FE.stratified_split(clean_enc(spark, sf), "target", "encounter_id"), "target", split="split")
    tr = s.where("split = 'train'")
    full = Pipeline(stages=[FE.vector_pipeline(CAT, NUMF), _lr()]).fit(tr)
    path = scratch_path(spark, "model")
    MD.save_model(full, path, {"features": CAT + NUMF, "threshold": 0.5, "kind": "logistic"})
    loaded, meta = MD.load_model(path)
    return MD.score_new_rows(loaded, s.where("split = 'test'"), meta["threshold"], keep=["encounter_id"])


# L7 / L8
@register("l7_coefficient_importance")
def l7(spark, sf):
    tr, _, _ = _train_test(spark, sf)
    m = _lr().fit(tr)
    return MD.coefficient_importance(m, MD.feature_names(tr), top=10)


@register("l8_impurity_importance")
def l8(spark, sf):
    tr, _, _ = _train_test(spark, sf)
    m = MD.forest(**MD.PRESETS["fast"]).fit(tr)
    return MD.impurity_importance(m, MD.feature_names(tr))


# L2
@register("l2_grid_search")
def l2(spark, sf):
    return B.search_logistic(_train_folds(spark, sf, MD.SEARCH_FOLDS), MD.lr_grid(), MD.SEARCH_FOLDS)


# L2: every fit of the grid meets the conditions of its minimum; the gradients are summed by Spark anew
@register("l2_optimality", "SELECT CAST(c AS INTEGER) AS candidate, CAST(f AS INTEGER) AS fold, true AS optimal "
          f"FROM range({len(MD.lr_grid())}) AS c(c), range({MD.SEARCH_FOLDS}) AS f(f)")
def l2o(spark, sf):
    batch = B.Batch(_train_folds(spark, sf, MD.SEARCH_FOLDS), B._folds(MD.SEARCH_FOLDS, "fold"))
    grid = [(c, i, p) for c, p in enumerate(MD.lr_grid()) for i in range(MD.SEARCH_FOLDS)]
    fits = batch.fit([B.Fit(f"train{i}", p["C"], p["penalty"]) for _, i, p in grid])
    of = spark.createDataFrame([(m, c, i) for m, (c, i, _) in enumerate(grid)], "model int, candidate int, fold int")
    return B.optimality(batch, fits).join(of, "model").select("candidate", "fold", (F.col("residual") < 1e-6).alias("optimal"))


# The reference's whole search
@register("l4_random_search")
def l4(spark, sf):
    from riskframe.session import scratch_path
    from riskframe.sources import io
    cands = MD.sample_grid(MD.RF_GRID)
    res = MD.search_cv(_train_folds(spark, sf, MD.SEARCH_FOLDS), lambda p: MD.forest(**p), cands)
    path = scratch_path(spark, "cv-results")          # S9: the search-result sink, read back
    io.write_table(res, path, "json")
    return spark.read.json(path)


# V2 with a fixed score column: per-fold metrics and their summary (SQL oracle)
FOLD_SQL = f"""fs AS (SELECT *, CAST((row_number() OVER (PARTITION BY target ORDER BY {H}, encounter_id) - 1) % 5
                     AS INTEGER) AS fold FROM scored),
per_fold AS (
  SELECT fold, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE label <> 1 AND score >= 0.5)
         AS fp, count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label <> 1 AND score < 0.5)
         AS tn FROM fs GROUP BY fold),
fm AS (SELECT fold, 'accuracy' AS metric, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS value FROM per_fold
       UNION ALL SELECT fold, 'precision', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) FROM per_fold
       UNION ALL SELECT fold, 'recall', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) FROM per_fold
       UNION ALL SELECT fold, 'f1', coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0) FROM per_fold),
cvs AS (SELECT 'test' AS side, metric, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max,
               stddev_pop(value) / nullif(avg(value), 0) AS stability FROM fm GROUP BY metric)"""


def _fixed_fold_frame(spark, sf):
    s = FE.stratified_folds(scored(spark, sf), "target", "encounter_id", 5)
    cm = s.groupBy("fold").agg(F.count_if((F.col("label") == 1) & (F.col("score") >= 0.5)).alias("tp"),
                               F.count_if((F.col("label") != 1) & (F.col("score") >= 0.5)).alias("fp"),
                               F.count_if((F.col("label") == 1) & (F.col("score") < 0.5)).alias("fn"),
                               F.count_if((F.col("label") != 1) & (F.col("score") < 0.5)).alias("tn"))
    r = M.rates_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    arr = F.array(*[F.struct(F.lit(k).alias("metric"), r[k].alias("value")) for k in ("accuracy", "precision",
                                                                                        "recall", "f1")])
    return cm.select("fold", F.lit("test").alias("side"), F.explode(arr).alias("_s")).select("fold", "side", "_s.*")


def _r6(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register("v2_cv_summary_fixed_score", scored_sql(
    "SELECT side, metric, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, round(max, 6) AS max, "
    "round(stability, 6) AS stability FROM cvs", FOLD_SQL))
def v2f(spark, sf):
    return _r6(V.summarize_cv(_fixed_fold_frame(spark, sf)))


# the metrics of all folds and both scores from one grouped curve
@register("v2_grouped_metrics", scored_sql("""
SELECT fold, model, n, coalesce((tp + tn) / n, 0.0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
       coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
       auc / (p * q) AS roc_auc, ap / p AS average_precision
FROM (SELECT fold, model, CAST(sum(pos + neg) AS DOUBLE) AS n, sum(pos) FILTER (WHERE s >= 0.5) AS tp, sum(neg) FILTER (WHERE s >= 0.5) AS fp,
             sum(pos) FILTER (WHERE s < 0.5) AS fn, sum(neg) FILTER (WHERE s < 0.5) AS tn, sum(pos) AS p, sum(neg) AS q,
             sum(neg * (ctp - pos / 2)) AS auc, sum(pos * ctp / (ctp + cfp)) AS ap
      FROM (SELECT *, sum(pos) OVER (PARTITION BY fold, model ORDER BY s DESC) AS ctp, sum(neg) OVER (PARTITION BY fold, model ORDER BY s DESC) AS cfp
            FROM (SELECT fold, model, s, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos, CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg
                  FROM (SELECT fold, 'score' AS model, score AS s, label FROM fs UNION ALL SELECT fold, 'score2', score2, label FROM fs)
                  GROUP BY fold, model, s)) GROUP BY fold, model)""", FOLD_SQL))
def v2g(spark, sf):
    s = FE.stratified_folds(scored(spark, sf), "target", "encounter_id", 5)
    both = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("s")) for m in ("score", "score2")])).alias("_s")
    return M.grouped_metrics(s.select("fold", "label", both).select("fold", "label", "_s.*"), ["fold", "model"], "label", "s")


@register("v9_verdicts_fixed_score", scored_sql(
    "SELECT metric, round(mean, 6) AS mean, round(std, 6) AS std, CASE WHEN stability < 0.05 THEN 'high' "
    "WHEN stability < 0.1 THEN 'medium' ELSE 'low' END AS stability_verdict, CASE WHEN std < 0.05 THEN 'consistent' "
    "WHEN std < 0.1 THEN 'moderately variable' ELSE 'highly variable' END AS spread_verdict, CAST(NULL AS VARCHAR) AS overfit_verdict FROM cvs", FOLD_SQL))
def v9(spark, sf):
    return _r6(V.verdicts(V.summarize_cv(_fixed_fold_frame(spark, sf))))


# V2 / V3 / V4 with fitted models (rows)
@register("v2_cross_validate_logistic")
def v2(spark, sf):
    return V.summarize_cv(V.cross_validate(_train_folds(spark, sf, 5), _lr, 5))


@register("v3_quick_validation")
def v3(spark, sf):
    return V.summarize_cv(V.cross_validate(_train_folds(spark, sf, 3), _lr, 3))


@register("v4_comprehensive_cv")
def v4(spark, sf):
    s = V.summarize_cv(V.cross_validate(_train_folds(spark, sf, V.CV_FOLDS), _lr, with_train=True))
    return s.join(V.overfitting(s), "metric", "left").join(
        V.verdicts(s).select("metric", "stability_verdict", "spread_verdict", "overfit_verdict"), "metric", "left")


# V5
@register("v5_nested_cv")
def v5(spark, sf):
    nested = B.nested_logistic(_train_folds(spark, sf, V.NESTED_OUTER), MD.lr_grid(), V.NESTED_OUTER, V.NESTED_INNER)
    summ, freq = V.nested_summary(nested)
    return nested.join(freq, "best_params").withColumns(
        {c: summ.select(c).scalar() for c in ("mean", "ci_low", "ci_high")})


# V6
REPLICATES = 20


def _boot_sql():
    aggs = []
    for b in range(REPLICATES):
        w = poisson1_sql(uniform_sql(f"42:{b}", "encounter_id"))
        aggs.append(f"SELECT {b} AS replicate, sum({w}) AS n, sum(CASE WHEN (label = 1) = (score >= 0.5) THEN {w} ELSE 0 END)"
                    f" AS c, sum(CASE WHEN label = 1 AND score >= 0.5 THEN {w} ELSE 0 END) AS tp, "
                    f"sum(CASE WHEN score >= 0.5 THEN {w} ELSE 0 END) AS pp, sum(CASE WHEN label = 1 THEN {w} ELSE 0 END)"
                    f" AS ap FROM scored")
    return "reps AS (SELECT replicate, CAST(c AS DOUBLE) / n AS accuracy, coalesce(CAST(tp AS DOUBLE) / nullif(pp, 0), " \
           "0.0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(ap, 0), 0.0) AS recall FROM (" + \
        " UNION ALL ".join(aggs) + "))"


@register("v6_metric_bootstrap", scored_sql(
    "SELECT replicate, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall "
    "FROM reps", _boot_sql()))
def v6m(spark, sf):
    return _r6(V.metric_bootstrap(scored(spark, sf), "encounter_id", REPLICATES))


@register("v6_bootstrap_summary", scored_sql(" UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(avg({m}), 6) AS mean, round(stddev_pop({m}), 6) AS std, "
    f"round(quantile_cont({m}, 0.5), 6) AS median, round(quantile_cont({m}, 0.025), 6) AS p2_5, "
    f"round(quantile_cont({m}, 0.975), 6) AS p97_5 FROM reps" for m in ("accuracy", "precision", "recall")),
    _boot_sql()))
def v6s(spark, sf):
    reps = V.metric_bootstrap(scored(spark, sf), "encounter_id", REPLICATES)
    return _r6(V.bootstrap_summary(reps, ["accuracy", "precision", "recall"]))


@register("v6_bootstrap_models")
def v6(spark, sf):
    tr, _, _ = _train_test(spark, sf)
    return V.bootstrap_summary(B.bootstrap_logistic(tr, V.BOOTSTRAP_REPLICATES), V.CV_METRICS)


# V7 / V8
@register("v7_learning_curve")
def v7(spark, sf):
    return B.learning_curve_logistic(_train_folds(spark, sf, V.CURVE_FOLDS), V.CURVE_SIZES, V.CURVE_FOLDS)


def _stability(spark, sf):
    tr, _, _ = _train_test(spark, sf)
    names = MD.feature_names(tr)
    scores, coefficients = B.stability_logistic(tr, V.STABILITY_RUNS, V.STABILITY_FOLDS)
    return scores, V.importance_steadiness(spark, [(n, abs(float(v))) for c in coefficients for n, v in zip(names, c)])


@register("v8_stability")
def v8(spark, sf):
    return V.stability_summary(_stability(spark, sf)[0])


@register("v8_importance_stability")
def v8i(spark, sf):
    return _stability(spark, sf)[1]


# X3 ANOVA F (SQL oracle)
XN = ["num_lab", "num_med", "num_proc", "time_in_hospital"]


def _anova_sql():
    parts = []
    for c in XN:
        parts.append(f"""SELECT '{c}' AS feature, (b - s * s / n) / (k - 1) / ((q - b) / (n - k)) AS f_stat,
  CAST(k - 1 AS DOUBLE) AS df_between, CAST(n - k AS DOUBLE) AS df_within FROM (
  SELECT count(*) AS k, sum(ni) AS n, sum(si) AS s, sum(qi) AS q, sum(si * si / ni) AS b FROM (
    SELECT target, count({c}) AS ni, sum(CAST({c} AS DOUBLE)) AS si, sum(CAST({c} AS DOUBLE) * {c}) AS qi
    FROM clean GROUP BY target))""")
    return clean_sql("SELECT feature, round(f_stat, 6) AS f_stat, df_between, df_within FROM (" +
                     " UNION ALL ".join(parts) + ")")


@register("x3_anova_f", _anova_sql())
def x3(spark, sf):
    a = X.anova_f(clean_enc(spark, sf), XN)
    return a.select("feature", F.round("f_stat", 6).alias("f_stat"), "df_between", "df_within")


# X4 mutual information over categorical columns (SQL oracle)
XC = ["race", "gender", "age", "specialty"]


@register("x4_mutual_information", clean_sql("""
SELECT feature, round(sum(nxy / n * ln(nxy * n / (nx * ny))), 6) AS mutual_info FROM (
  SELECT feature, x, y, nxy, sum(nxy) OVER (PARTITION BY feature, x) AS nx, sum(nxy) OVER (PARTITION BY feature, y) AS ny,
         sum(nxy) OVER (PARTITION BY feature) AS n
  FROM (SELECT feature, x, y, CAST(count(*) AS DOUBLE) AS nxy FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS x, target AS y FROM clean WHERE {c} IS NOT NULL" for c in XC) +
    """) GROUP BY feature, x, y)) GROUP BY feature"""))
def x4(spark, sf):
    mi = X.mutual_information(clean_enc(spark, sf), XC)
    return mi.select("feature", F.round("mutual_info", 6).alias("mutual_info"))


# X4 over continuous columns: the k-nearest-neighbour estimate, in SQL over all pairs
@register("x4_neighbour_information", clean_sql(f"""
SELECT feature, greatest(0.0, max(pn.psi) + avg(pk.psi) - avg(py.psi) - avg(pm.psi)) AS mutual_info
FROM (SELECT q.feature, q.id, q.n_y, q.k, (SELECT count(*) FROM big b WHERE b.feature = q.feature AND CASE WHEN q.r > 0 THEN abs(b.v - q.v) < q.r ELSE b.v = q.v END) AS m,
             count(*) OVER (PARTITION BY q.feature) AS n
      FROM (SELECT a.feature, a.id, a.v, a.n_y, a.k, a.r FROM near a WHERE rn = k) q) x
JOIN psi pn ON pn.n = x.n JOIN psi pk ON pk.n = x.k JOIN psi py ON py.n = x.n_y JOIN psi pm ON pm.n = x.m GROUP BY feature""",
    "\npts AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, encounter_id AS id, target AS y, CAST({c} AS DOUBLE) AS v FROM clean WHERE {c} IS NOT NULL" for c in XN) + """),
big AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY feature, y) AS n_y FROM pts) WHERE n_y > 1),
near AS (SELECT a.feature, a.id, a.v, a.n_y, least(3, a.n_y - 1) AS k, abs(a.v - b.v) AS r,
                row_number() OVER (PARTITION BY a.feature, a.id ORDER BY abs(a.v - b.v)) AS rn
         FROM big a JOIN big b ON a.feature = b.feature AND a.y = b.y AND a.id <> b.id),
psi AS (SELECT n, -0.5772156649015329 + coalesce(sum(1.0::DOUBLE / n) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS psi
        FROM (SELECT unnest(range(1, 200001)) AS n))"""))
def x4n(spark, sf):
    return X.neighbour_information(clean_enc(spark, sf), XN)


# X6 VIF of three columns (closed-form 3x3 inverse diagonal in SQL)
XV = ["num_lab", "num_med", "num_proc"]


@register("x6_vif", clean_sql(f"""
SELECT feature, round(v, 6) AS vif, v > 10 AS high FROM (
  SELECT a, b, c, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM (
    SELECT corr({XV[0]}, {XV[1]}) AS a, corr({XV[0]}, {XV[2]}) AS b, corr({XV[1]}, {XV[2]}) AS c FROM clean)),
  LATERAL (VALUES ('{XV[0]}', (1 - c * c) / det), ('{XV[1]}', (1 - b * b) / det), ('{XV[2]}', (1 - a * a) / det)) t(feature, v)"""))
def x6(spark, sf):
    v = X.vif(clean_enc(spark, sf), XV)
    return v.select("feature", F.round("vif", 6).alias("vif"), "high")


# X7 interaction screen (SQL oracle)
XI = ["num_lab", "num_med", "num_proc", "long_stay"]


@register("x7_interaction_screen", clean_sql(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr(CAST({a} AS DOUBLE) * {b}, CAST(target AS DOUBLE)), 6) "
    f"AS corr FROM clean" for i, a in enumerate(XI) for b in XI[i + 1:])))
def x7(spark, sf):
    s = X.interaction_screen(clean_enc(spark, sf), XI)
    return s.select("feature_a", "feature_b", F.round("corr", 6).alias("corr"))


# X1-X11 share one preparation: training rows fit the scaling, the weights and the models, test rows are explained
def _numeric(spark, sf, columns, folds=None):
    """(training rows, test rows, assemble): ``assemble(columns)`` gives a pipeline that scales raw columns (null: the
    training mean) into the feature vector; ``fold`` numbers the training rows where asked for."""
    s = FE.stratified_split(clean_enc(spark, sf), "target", "encounter_id")
    s = cut_lineage(FE.balanced_weights(s, "target", split="split").select("encounter_id", "target", "split", "weight", *columns))
    tr, te = s.where("split = 'train'"), s.where("split = 'test'")
    if folds:
        tr = cut_lineage(FE.stratified_folds(tr, "target", "encounter_id", folds))
    return tr, te, lambda cols: FE.vector_pipeline([], cols).fit(tr)


def _vectors(prep, df):
    return prep.transform(df.drop("features", *[c for c in df.columns if c.endswith("__z")]))


@register("x9_linear_shap")
def x9(spark, sf):
    tr, te, assemble = _numeric(spark, sf, XN)
    prep = assemble(XN)
    m = _lr().fit(_vectors(prep, tr))
    shap = X.linear_shap(_vectors(prep, te), [f"{c}__z" for c in XN], m.coefficients.toArray().tolist())
    return shap.withColumn("feature", F.regexp_replace("feature", "__z$", ""))


# X2 / X11 permutation importance on the test rows, and side by side with impurity (rows)
def _permuted(spark, sf):
    tr, te, assemble = _numeric(spark, sf, XN)
    prep = assemble(XN)
    m = MD.forest(**MD.PRESETS["fast"]).fit(_vectors(prep, tr))
    return m, X.permutation_importance(m, te, XN, lambda df: _vectors(prep, df), "encounter_id")


@register("x2_permutation_importance")
def x2(spark, sf):
    return _permuted(spark, sf)[1]


@register("x11_impurity_vs_permutation")
def x11(spark, sf):
    m, permuted = _permuted(spark, sf)
    imp = X.ranked(MD.impurity_importance(m, XN), "importance", "impurity", "forest")
    return X.side_by_side(imp, X.ranked(permuted, "importance_mean", "permutation", "forest"), "impurity", "permutation")


# X1 / X10 / A22 multi-method importance table and its ranking (rows)
def _importance_long(spark, sf):
    from riskframe.operators.explore import target_correlations
    tr, te, assemble = _numeric(spark, sf, XN)
    prep = assemble(XN)
    v = _vectors(prep, tr)
    lr, rf = _lr().fit(v), MD.forest(**MD.PRESETS["fast"]).fit(v)
    shap = X.linear_shap(_vectors(prep, te), [f"{c}__z" for c in XN], lr.coefficients.toArray().tolist())
    parts = [(MD.coefficient_importance(lr, XN), "abs_coefficient", "coefficient", "logistic"),
             (MD.impurity_importance(rf, XN), "importance", "impurity", "forest"),
             (X.permutation_importance(rf, te, XN, lambda df: _vectors(prep, df), "encounter_id"), "importance_mean", "permutation", "forest"),
             (shap.withColumn("feature", F.regexp_replace("feature", "__z$", "")), "mean_abs_shap", "shap", "logistic"),
             (target_correlations(tr, XN).withColumnRenamed("column", "feature"), "abs_corr", "correlation", ""),
             (X.anova_f(tr, XN), "f_stat", "anova_f", ""),
             (X.mutual_information(tr, XN, bins=10), "mutual_info", "mutual_info", "")]
    return reduce(DataFrame.unionByName, [X.ranked(df.select("feature", value), value, method, model) for df, value, method, model in parts])


@register("x1_importance_table")
def x1(spark, sf):
    return _importance_long(spark, sf)


@register("a22_importance_ranking")
def a22(spark, sf):
    from riskframe.operators.explore import importance_ranking
    long = _importance_long(spark, sf).where(F.col("method").isin("coefficient", "impurity"))
    return importance_ranking(long.select("model", "feature", F.col("value").alias("importance")), 15)


@register("x10_feature_summary")
def x10(spark, sf):
    """Per feature: methods that rank it in their first three, mean rank, VIF, its strongest product term with another,
    verdict of its stability, and its ranking by elimination."""
    ranks = _importance_long(spark, sf).groupBy("feature").agg(F.count_if(F.col("rank") <= 3).alias("top3_methods"),
                                                               F.avg("rank").alias("mean_rank"))
    c = clean_enc(spark, sf)
    pairs = X.interaction_screen(c, XN)
    both = pairs.select(F.explode(F.array("feature_a", "feature_b")).alias("feature"), F.abs("corr").alias("c"))
    strongest = both.groupBy("feature").agg(F.max("c").alias("strongest_interaction"))
    return ranks.join(X.vif(c, XN), "feature").join(strongest, "feature") \
        .join(_importance_stability(spark, sf).select("feature", F.col("verdict").alias("stability")), "feature") \
        .join(_rfe(spark, sf, XN)[1].select("feature", F.col("ranking").alias("rfe_ranking")), "feature")


# X5 RFE with CV (rows)
def _cv_auc(tr, prep, folds):
    per_fold = V.cross_validate(cut_lineage(_vectors(prep, tr)), _lr, folds).where("metric = 'roc_auc' AND side = 'test'")
    return V.summarize_cv(per_fold).select("mean", "std").first()


def _rfe(spark, sf, feats):
    tr, _, assemble = _numeric(spark, sf, feats, folds=5)

    def importance(cols):
        m = _lr().fit(_vectors(assemble(cols), tr))
        return dict(zip(cols, map(abs, m.coefficients.toArray().tolist())))
    return X.rfe_cv(tr, feats, importance, lambda cols: _cv_auc(tr, assemble(cols), 5), step=1, min_features=RFE_MIN)


@register("x5_rfe_cv")
def x5(spark, sf):
    return _rfe(spark, sf, list(dict.fromkeys(NUMF + XN)))[0]


@register("x5_rfe_ranking")
def x5r(spark, sf):
    return _rfe(spark, sf, list(dict.fromkeys(NUMF + XN)))[1]


# X8 importance stability under bootstrap (rows)
def _importance_stability(spark, sf):
    tr, _, assemble = _numeric(spark, sf, XN)
    drawn = {f"in{b}": poisson1(uniform(f"42:{b}", F.col("encounter_id"))) for b in range(X.STABILITY_RESAMPLES)}
    fits = (batch := B.Batch(_vectors(assemble(XN), tr), drawn)).fit([B.Fit(n) for n in batch.names])
    long = spark.createDataFrame([(f.design, n, abs(float(c))) for f in fits for n, c in zip(XN, f.coefficients)], "resample string, feature string, value double")
    rank = F.row_number().over(Window.partitionBy("resample").orderBy(F.desc("value"), "feature"))      # a row a feature
    return X.importance_stability(long.withColumn("rank", rank))


@register("x8_importance_stability")
def x8(spark, sf):
    return _importance_stability(spark, sf)


# L6 on a stream: the fitted pipeline scores test rows arriving as parquet files (rows)
@register("l6_stream_scoring")
def l6s(spark, sf):
    from pyspark.ml import Pipeline
    from riskframe.session import scratch_path
    from riskframe.streaming.scoring import score_stream
    s = FE.balanced_weights(FE.stratified_split(clean_enc(spark, sf), "target", "encounter_id"), "target", split="split")
    tr = s.where("split = 'train'")
    full = Pipeline(stages=[FE.vector_pipeline(CAT, NUMF), _lr()]).fit(tr)
    src = scratch_path(spark, "stream-src")
    te = s.where("split = 'test'").drop("weight")
    te.repartition(4).write.parquet(src)
    sink, ck, rules = (scratch_path(spark, n) for n in ("stream-sink", "stream-ck", "stream-rules"))
    q = score_stream(spark, full, src, te.schema, sink, ck, keep=["encounter_id", "target"], rules_dir=rules,
                     rule_columns=["score", "target"])
    q.awaitTermination()
    return spark.read.parquet(sink)


# X7 interaction gain: 3-fold CV AUC gain of every product term (rows)
@register("x7_interaction_gain")
def x7g(spark, sf):
    tr, _, _ = _numeric(spark, sf, XI, folds=3)
    pairs = [(a, b) for i, a in enumerate(XI) for b in XI[i + 1:]]
    return X.interaction_gain(tr, pairs, XI, lambda frame, cols: _cv_auc(frame, FE.vector_pipeline([], cols).fit(frame), 3)[0])


# L3 out-of-bag score of a bagged forest (rows)
@register("l3_forest_oob_score")
def l3oob(spark, sf):
    tr, _, _ = _train_test(spark, sf)
    oob = MD.oob_forest(tr, "encounter_id", MD.PRESETS["fast"]["numTrees"], **MD.PRESETS["fast"])
    return M.all_metrics(oob, "target", "score", 0.5).withColumn("oob_rows", oob.agg(F.count(F.lit(1))).scalar())


# X9 for a non-linear model: sampled-permutation Shapley values of the forest (rows)
@register("x9_forest_shap")
def x9f(spark, sf):
    tr, te, _ = _train_test(spark, sf)
    m = MD.forest(**MD.PRESETS["fast"]).fit(tr)
    names = MD.feature_names(tr)
    shap = X.permutation_shap(m, te, "encounter_id")
    name_df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "feature_index int, feature string")
    return shap.join(F.broadcast(name_df), "feature_index").select("feature", "mean_abs_shap", "mean_shap", "rows_explained")
