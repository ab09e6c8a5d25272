"""Queries for evaluation metrics (M1-M13, W6) over the fixed score columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.plans.base import scored, scored_sql
from riskframe.plans.registry import register


def _r(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _ratio(n, d):
    return f"coalesce(CAST({n} AS DOUBLE) / nullif({d}, 0), 0.0)"


_CM = """cm AS (SELECT count(*) FILTER (WHERE label <> 1 AND score < {t}) AS tn,
                      count(*) FILTER (WHERE label <> 1 AND score >= {t}) AS fp,
                      count(*) FILTER (WHERE label = 1 AND score < {t}) AS fn,
                      count(*) FILTER (WHERE label = 1 AND score >= {t}) AS tp FROM scored)"""

_RATES = (f"round({_ratio('tp + tn', 'tp + tn + fp + fn')}, 6) AS accuracy, round({_ratio('tp', 'tp + fp')}, 6) AS "
          f"precision, round({_ratio('tp', 'tp + fn')}, 6) AS recall, round({_ratio('2 * tp', '2 * tp + fp + fn')}, 6) "
          f"AS f1, round({_ratio('tn', 'tn + fp')}, 6) AS specificity, round({_ratio('tn', 'tn + fn')}, 6) AS npv")

def _sc(col: str = "score") -> str:
    return f"""sc AS (SELECT CAST({col} AS DOUBLE) AS score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::DOUBLE AS pos,
                     sum(CASE WHEN label = 1 THEN 0 ELSE 1 END)::DOUBLE AS neg FROM scored WHERE {col} IS NOT NULL
                     GROUP BY {col}),
curve AS (SELECT score AS threshold, pos, neg,
                 sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
                 sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM sc),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM sc),
pts AS (SELECT threshold, pos, neg, tp, fp, coalesce(tp / nullif(P, 0), 0.0) AS tpr, coalesce(fp / nullif(N, 0), 0.0) AS fpr,
               coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(P, 0), 0.0) AS recall,
               coalesce(2 * tp / nullif(tp + fp + P, 0), 0.0) AS f1 FROM curve, tot)"""


_SC = _sc("score")


# M1
@register("m1_confusion_matrix", scored_sql("SELECT * FROM cm", _CM.format(t=0.5)))
def m1(spark, sf):
    return M.confusion(scored(spark, sf), "label", "score", 0.5)


@register("m1_confusion_normalized", scored_sql(
    f"SELECT round({_ratio('tn', 'tn + fp')}, 6) AS tn_rate, round({_ratio('fp', 'tn + fp')}, 6) AS fp_rate, "
    f"round({_ratio('fn', 'fn + tp')}, 6) AS fn_rate, round({_ratio('tp', 'fn + tp')}, 6) AS tp_rate FROM cm",
    _CM.format(t=0.5)))
def m1n(spark, sf):
    cm = M.confusion_normalized(M.confusion(scored(spark, sf), "label", "score", 0.5))
    return _r(cm, cm.columns)


# M2 / M3
@register("m2_classification_metrics", scored_sql(f"SELECT 0.5::DOUBLE AS threshold, tn, fp, fn, tp, {_RATES} FROM cm",
                                                  _CM.format(t=0.5)))
def m2(spark, sf):
    return M.classification_metrics(scored(spark, sf), "label", "score", 0.5)


@register("m3_metrics_at_0_7", scored_sql(f"SELECT 0.7::DOUBLE AS threshold, tn, fp, fn, tp, {_RATES} FROM cm",
                                          _CM.format(t=0.7)))
def m3(spark, sf):
    return M.classification_metrics(scored(spark, sf), "label", "score", 0.7)


# M4
@register("m4_roc_auc", scored_sql("""
SELECT round(sum(pos * (cneg - neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc
FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg FROM sc)""", _SC))
def m4(spark, sf):
    return _r(M.roc_auc(scored(spark, sf), "label", "score"), ["roc_auc"])


@register("m4_roc_auc_model2", scored_sql("""
SELECT round(sum(pos * (cneg - neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc
FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg FROM sc)""",
                                                 _sc("score2")))
def m4b(spark, sf):
    return _r(M.roc_auc(scored(spark, sf), "label", "score2"), ["roc_auc"])


# M5
@register("m5_average_precision", scored_sql(
    "SELECT round(sum(pos * precision) / (SELECT P FROM tot), 6) AS average_precision FROM pts", _SC))
def m5(spark, sf):
    return _r(M.average_precision(scored(spark, sf), "label", "score"), ["average_precision"])


@register("m5_losses", scored_sql(
    "SELECT round(-avg(label * ln(p) + (1 - label) * ln(1 - p)), 6) AS log_loss, "
    "round(avg((score - label) * (score - label)), 6) AS brier FROM (SELECT label, score, "
    "least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM scored)"))
def m5l(spark, sf):
    d = M.probability_losses(scored(spark, sf), "label", "score")
    return _r(d, d.columns)


# M6
_PTS = ["tpr", "fpr", "precision", "recall", "f1"]


@register("m6_curve_points", scored_sql(
    "SELECT threshold, pos, neg, tp, fp, " + ", ".join(f"round({c}, 6) AS {c}" for c in _PTS) + " FROM pts UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0, 0, 0, 0, 0, 1, 0, 0", _SC))
def m6(spark, sf):
    return _r(M.with_end_points(M.curve(scored(spark, sf), "label", "score")), _PTS)


# M7
@register("m7_best_f1_threshold", scored_sql("""
SELECT threshold, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall,
       CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp
FROM pts WHERE threshold = (SELECT min(threshold) FROM pts WHERE f1 = (SELECT max(f1) FROM pts))""", _SC))
def m7(spark, sf):
    return M.best_f1_threshold(scored(spark, sf), "label", "score")


# M8
@register("m8_constrained_thresholds", scored_sql("""
SELECT o.objective, coalesce(b.threshold, 0.5) AS threshold, round(coalesce(b.value, 0.0), 6) AS value
FROM (VALUES ('precision'), ('recall')) o(objective) LEFT JOIN (
  SELECT 'precision' AS objective, min(threshold) AS threshold, max(precision) AS value FROM pts
  WHERE recall >= 0.3 AND precision = (SELECT max(precision) FROM pts WHERE recall >= 0.3)
  UNION ALL
  SELECT 'recall', min(threshold), max(recall) FROM pts
  WHERE precision >= 0.3 AND recall = (SELECT max(recall) FROM pts WHERE precision >= 0.3)) b USING (objective)""",
                                                      _SC))
def m8(spark, sf):
    return M.constrained_thresholds(scored(spark, sf), "label", "score")


# M9
_GRID_SQL = "grid AS (SELECT round(0.10 + 0.01 * i, 2)::DOUBLE AS threshold FROM range(80) t(i))"
_SWEEP_SQL = """sweep AS (
  SELECT threshold, tp, fp,
         round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + (P - tp), 0), 0.0), 6) AS f1,
         round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 6) AS precision,
         round(coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0.0), 6) AS recall,
         round(coalesce(CAST(tp + (N - fp) AS DOUBLE) / nullif(P + N, 0), 0.0), 6) AS accuracy
  FROM (SELECT g.threshold, count(*) FILTER (WHERE s.label = 1 AND s.score >= g.threshold) AS tp,
               count(*) FILTER (WHERE s.label <> 1 AND s.score >= g.threshold) AS fp
        FROM grid g, (SELECT label, score FROM scored WHERE score IS NOT NULL) s GROUP BY g.threshold),
       (SELECT count(*) FILTER (WHERE label = 1) AS P, count(*) FILTER (WHERE label <> 1) AS N FROM scored
        WHERE score IS NOT NULL))"""


@register("m9_threshold_sweep", scored_sql("SELECT * FROM sweep", _GRID_SQL, _SWEEP_SQL))
def m9(spark, sf):
    return M.threshold_sweep(scored(spark, sf), "label", "score")


@register("m9_sweep_best", scored_sql(" UNION ALL ".join(
    f"SELECT '{m}' AS metric, min(threshold) AS threshold, max({m}) AS value FROM sweep "
    f"WHERE {m} = (SELECT max({m}) FROM sweep)" for m in ("f1", "precision", "recall", "accuracy")),
    _GRID_SQL, _SWEEP_SQL))
def m9b(spark, sf):
    return M.sweep_best(M.threshold_sweep(scored(spark, sf), "label", "score"))


# M10
@register("m10_score_distribution", scored_sql("""
SELECT label AS class, count(*) AS n, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std,
       round(abs((SELECT avg(score) FROM scored WHERE label = 1) - (SELECT avg(score) FROM scored WHERE label = 0)), 6)
         AS separation
FROM scored GROUP BY label"""))
def m10(spark, sf):
    d = M.score_distribution(scored(spark, sf), "label", "score")
    return _r(d, ["mean", "std", "separation"])


# M12
@register("m12_class_distribution", scored_sql("""
SELECT kind, class, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY kind), 6) AS share FROM (
  SELECT 'actual' AS kind, CAST(label AS INTEGER) AS class FROM scored
  UNION ALL SELECT 'predicted', CAST(score >= 0.5 AS INTEGER) FROM scored) GROUP BY kind, class"""))
def m12(spark, sf):
    return M.class_distribution(scored(spark, sf), "label", "score", 0.5)


# M13
@register("m13_score_histogram", scored_sql("""
SELECT class, bin, round(lo0 + bin * (hi0 - lo0) / 40, 6) AS lo, round(lo0 + (bin + 1) * (hi0 - lo0) / 40, 6) AS hi, count(*) AS n
FROM (SELECT s.label AS class, lo0, hi0,
             CAST(CASE WHEN hi0 = lo0 THEN 0 ELSE least(floor((s.score - lo0) / ((hi0 - lo0) / 40)), 39) END AS INTEGER) AS bin
      FROM scored s JOIN (SELECT label, min(score) AS lo0, max(score) AS hi0 FROM scored GROUP BY label) r
      ON s.label = r.label WHERE s.score IS NOT NULL)
GROUP BY class, bin, lo0, hi0"""))
def m13(spark, sf):
    return _r(M.score_histogram(scored(spark, sf), "label", "score", 40), ["lo", "hi"])


# M11 / A23 / A24 (two fixed scores compared as two models)
@register("a23_best_model", scored_sql("""
SELECT model, round(roc_auc, 6) AS roc_auc, round(brier, 6) AS brier, roc_auc = max(roc_auc) OVER () AND
       model = (SELECT min(model) FROM m WHERE roc_auc = (SELECT max(roc_auc) FROM m)) AS is_best
FROM m""", _SC.replace("sc AS", "sc1 AS").replace("FROM sc)", "FROM sc1)").replace("FROM sc\n", "FROM sc1\n"),
                                           """a1 AS (SELECT sum(pos * (cneg - neg / 2.0)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg FROM sc1)),
sc2 AS (SELECT score2 AS score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::DOUBLE AS pos,
               sum(CASE WHEN label = 1 THEN 0 ELSE 1 END)::DOUBLE AS neg FROM scored GROUP BY score2),
a2 AS (SELECT sum(pos * (cneg - neg / 2.0)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg FROM sc2)),
m AS (SELECT 'score' AS model, round((SELECT auc FROM a1), 6) AS roc_auc,
             round((SELECT avg((score - label) * (score - label)) FROM scored), 6) AS brier
      UNION ALL SELECT 'score2', round((SELECT auc FROM a2), 6),
             round((SELECT avg((score2 - label) * (score2 - label)) FROM scored), 6))"""))
def a23(spark, sf):
    from riskframe.operators import explore
    s = scored(spark, sf)
    rows = None
    for name in ("score", "score2"):
        auc = M.roc_auc(s, "label", name).select(F.lit(name).alias("model"), F.lit("roc_auc").alias("metric"),
                                                 F.round("roc_auc", 6).alias("value"))
        br = M.probability_losses(s, "label", name).select(F.lit(name).alias("model"), F.lit("brier").alias("metric"),
                                                           F.round("brier", 6).alias("value"))
        u = auc.unionByName(br)
        rows = u if rows is None else rows.unionByName(u)
    return explore.best_model(rows, "roc_auc")


@register("a24_metric_bands", scored_sql(f"""
SELECT CASE WHEN auc >= 0.7 THEN 'good' WHEN auc >= 0.6 THEN 'fair' ELSE 'poor' END AS auc_band,
       CASE WHEN f1 >= 0.8 THEN 'good' WHEN f1 >= 0.6 THEN 'fair' ELSE 'poor' END AS f1_band
FROM (SELECT (SELECT sum(pos * (cneg - neg / 2.0)) / (sum(pos) * sum(neg))
              FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg FROM sc)) AS auc,
             (SELECT {_ratio('2 * tp', '2 * tp + fp + fn')} FROM cm) AS f1)""", _SC, _CM.format(t=0.5)))
def a24(spark, sf):
    from riskframe.operators import explore
    s = scored(spark, sf)
    auc = M.roc_auc(s, "label", "score").scalar()
    f1 = M.classification_metrics(s, "label", "score", 0.5).select("f1").scalar()
    return s.agg(F.count(F.lit(1))).select(explore.band(auc, 0.7, 0.6).alias("auc_band"), explore.band(f1, 0.8, 0.6).alias("f1_band"))


# M4 + M5 + M7 from one curve
@register("m7_rank_summary", scored_sql("""
SELECT round(sum(neg * (tp - pos / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc,
       round(sum(pos * precision) / sum(pos), 6) AS average_precision,
       (SELECT min(threshold) FROM pts WHERE f1 = (SELECT max(f1) FROM pts)) AS best_threshold,
       round((SELECT max(f1) FROM pts), 6) AS best_f1
FROM pts""", _SC))
def m7s(spark, sf):
    return _r(M.rank_summary(scored(spark, sf), "label", "score"), ["roc_auc", "average_precision", "best_f1"])
