"""Relational evaluation metrics from ``(label, score[, weight])`` rows.

Rank metrics never sort the scored table: rows are first aggregated to one
row per distinct score (partial aggregation), and cumulative counts over the
score order come from :func:`riskframe.operators.ordered.running_sums`, which
splits the score range into ordered buckets when the distinct-score table is
large. The threshold sweep bins scores once and sums suffixes over 80 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import qcol, safe_ratio
from riskframe.operators.ordered import running_sums
from riskframe.session import cut_lineage

# --- fixed values --------------------------------------------------------------
LOG_EPS = 2.220446049250313e-16
GRID = [round(0.10 + 0.01 * i, 2) for i in range(80)]       # 0.10 .. 0.89
MIN_RECALL_FOR_PRECISION = 0.3
MIN_PRECISION_FOR_RECALL = 0.3
DEFAULT_THRESHOLD = 0.5
# --------------------------------------------------------------------------------


def _w(weight: str | None) -> Column:
    return qcol(weight).cast("double") if weight else F.lit(1.0)


# M1 -------------------------------------------------------------------------------
def confusion(df: DataFrame, label: str = "label", score: str = "score", threshold: float = DEFAULT_THRESHOLD,
              pred: str | None = None) -> DataFrame:
    """One row ``(tn, fp, fn, tp)``; prediction = score >= threshold (or an explicit ``pred`` column)."""
    p = qcol(pred) == 1 if pred else qcol(score) >= threshold
    y = qcol(label) == 1
    return df.agg(F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))


def confusion_normalized(cm: DataFrame) -> DataFrame:
    """Row-normalised confusion matrix (by true class)."""
    return cm.select(safe_ratio(F.col("tn"), F.col("tn") + F.col("fp")).alias("tn_rate"),
                     safe_ratio(F.col("fp"), F.col("tn") + F.col("fp")).alias("fp_rate"),
                     safe_ratio(F.col("fn"), F.col("fn") + F.col("tp")).alias("fn_rate"),
                     safe_ratio(F.col("tp"), F.col("fn") + F.col("tp")).alias("tp_rate"))


# M2 / M3 --------------------------------------------------------------------------
def rates_from_counts(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """accuracy, precision, recall, f1, specificity, npv; 0 when a denominator is 0."""
    precision = safe_ratio(tp, tp + fp)
    recall = safe_ratio(tp, tp + fn)
    return {
        "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
        "specificity": safe_ratio(tn, tn + fp),
        "npv": safe_ratio(tn, tn + fn),
    }


def classification_metrics(df: DataFrame, label: str = "label", score: str = "score",
                           threshold: float = DEFAULT_THRESHOLD, digits: int = 6) -> DataFrame:
    cm = confusion(df, label, score, threshold)
    r = rates_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    return cm.select(F.lit(float(threshold)).alias("threshold"), "tn", "fp", "fn", "tp",
                     *[F.round(v, digits).alias(k) for k, v in r.items()])


# per-score aggregate + curves (M4-M7, W6) -----------------------------------------
def score_counts(df: DataFrame, label: str = "label", score: str = "score", weight: str | None = None,
                 by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score (and group): weighted positives and negatives."""
    w = _w(weight)
    return df.where(qcol(score).isNotNull()).groupBy(*map(qcol, by), qcol(score).cast("double").alias("score")).agg(
        F.sum(F.when(qcol(label) == 1, w).otherwise(0.0)).alias("pos"),
        F.sum(F.when(qcol(label) == 1, 0.0).otherwise(w)).alias("neg"))


def curve(df: DataFrame, label: str = "label", score: str = "score", weight: str | None = None) -> DataFrame:
    """One point per distinct threshold t (predict score >= t): tp, fp, tpr, fpr, precision, recall. The curves' end
    points at no predictions are in :func:`with_end_points`.

    Running sums over descending score (ordered by the negated score).
    """
    sc = score_counts(df, label, score, weight).withColumn("_neg_score", -F.col("score"))
    cum = running_sums(sc, ["_neg_score"], {"tp": "pos", "fp": "neg"})
    tot_p = sc.agg(F.sum("pos")).scalar()
    tot_n = sc.agg(F.sum("neg")).scalar()
    return cum.select(F.col("score").alias("threshold"), "pos", "neg", "tp", "fp",
                      safe_ratio(F.col("tp"), tot_p).alias("tpr"), safe_ratio(F.col("fp"), tot_n).alias("fpr"),
                      F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
                      safe_ratio(F.col("tp"), tot_p).alias("recall"),
                      safe_ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + tot_p).alias("f1"))


def with_end_points(points: DataFrame) -> DataFrame:
    """A curve and the point before its first threshold (infinite): nothing predicted, tpr and fpr 0, precision 1."""
    start = {"threshold": float("inf"), "precision": 1.0}
    first = points.agg(*[F.lit(start.get(c, 0.0)).cast(points.schema[c].dataType).alias(c) for c in points.columns])
    return first.unionByName(points)


# M4 -------------------------------------------------------------------------------
def roc_auc(df: DataFrame, label: str = "label", score: str = "score", weight: str | None = None) -> DataFrame:
    """Trapezoidal ROC AUC = Mann-Whitney U with mid-ranks: sum pos(s) * (neg below s + neg(s)/2) / (P N)."""
    sc = score_counts(df, label, score, weight)
    cum = running_sums(sc, ["score"], {"_cneg": "neg"})
    return cum.agg(F.try_divide(F.sum(F.col("pos") * (F.col("_cneg") - F.col("neg") / 2.0)),
                                F.sum("pos") * F.sum("neg")).alias("roc_auc"))


# M5 -------------------------------------------------------------------------------
def average_precision(df: DataFrame, label: str = "label", score: str = "score",
                      weight: str | None = None) -> DataFrame:
    """AP = sum over thresholds (descending) of (R_n - R_{n-1}) * P_n."""
    c = curve(df, label, score, weight)
    tot_p = c.agg(F.sum("pos")).scalar()
    return c.agg(F.try_divide(F.sum(F.col("pos") * F.col("precision")), tot_p).alias("average_precision"))


def probability_losses(df: DataFrame, label: str = "label", score: str = "score", eps: float = LOG_EPS) -> DataFrame:
    """Log loss (clipped) and Brier score."""
    p = F.least(F.greatest(qcol(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = qcol(label).cast("double")
    return df.agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
                  F.avg(F.pow(qcol(score).cast("double") - y, 2)).alias("brier"))


def all_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = DEFAULT_THRESHOLD,
                digits: int = 6) -> DataFrame:
    """One row: threshold metrics + AUC, AP, log loss, Brier. The rows are scored once: (label, score) is written to the
    shared folder, and every metric reads that."""
    df = cut_lineage(df.select(qcol(label).alias(label), qcol(score).alias(score)))
    base = classification_metrics(df, label, score, threshold, digits)
    return base.withColumns({
        "roc_auc": F.round(roc_auc(df, label, score).scalar(), digits),
        "average_precision": F.round(average_precision(df, label, score).scalar(), digits),
        "log_loss": F.round(probability_losses(df, label, score).select("log_loss").scalar(), digits),
        "brier": F.round(probability_losses(df, label, score).select("brier").scalar(), digits),
    })


# M7 / M8 --------------------------------------------------------------------------
def _first_best(c: DataFrame, metric: str, feasible: Column | None = None) -> DataFrame:
    """Row of ``c`` with max ``metric`` (smallest threshold on ties) among feasible rows.

    One aggregate: the max of struct(metric, -threshold) orders by metric, then by smaller threshold.
    """
    src = c.where(feasible) if feasible is not None else c
    best = src.agg(F.max(F.struct(F.col(metric).alias("m"), (-F.col("threshold")).alias("nt"))).alias("_b")) \
        .select((-F.col("_b.nt")).alias("_bt"))
    return src.join(best, src["threshold"] == best["_bt"]).drop("_bt")


def best_f1_threshold(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Threshold maximising F1 over the distinct scores, re-evaluated: (threshold, f1, precision, recall, tp, fp)."""
    c = curve(df, label, score)
    return _first_best(c, "f1").select("threshold", F.round("f1", 6).alias("f1"),
                                       F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"),
                                       F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"))


def constrained_thresholds(df: DataFrame, label: str = "label", score: str = "score",
                           min_recall: float = MIN_RECALL_FOR_PRECISION,
                           min_precision: float = MIN_PRECISION_FOR_RECALL) -> DataFrame:
    """Two rows: max precision s.t. recall >= r; max recall s.t. precision >= p (default 0.5 if infeasible)."""
    c = curve(df, label, score)
    a = _first_best(c, "precision", F.col("recall") >= min_recall).select(
        F.lit("precision").alias("objective"), "threshold", F.col("precision").alias("value"))
    b = _first_best(c, "recall", F.col("precision") >= min_precision).select(
        F.lit("recall").alias("objective"), "threshold", F.col("recall").alias("value"))
    spark = df.sparkSession
    dflt = spark.createDataFrame([("precision",), ("recall",)], "objective string")
    u = a.unionByName(b)
    return dflt.join(u, "objective", "left").select(
        "objective", F.coalesce(F.col("threshold"), F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.round(F.coalesce(F.col("value"), F.lit(0.0)), 6).alias("value"))


# M9 -------------------------------------------------------------------------------
def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score",
                    grid: Sequence[float] = GRID) -> DataFrame:
    """Metrics at each grid threshold (predict score >= t), from ONE pass: every row gets the index
    of the largest grid value <= its score, counts per (index, label) are aggregated (<= len(grid)+1
    rows) and each threshold sums the counts at or above its index."""
    arr = F.array(*[F.lit(float(t)) for t in grid])
    k = F.size(F.filter(arr, lambda t: t <= qcol(score).cast("double"))) - 1
    cnt = df.where(qcol(score).isNotNull()).groupBy(k.alias("k")).agg(
        F.count_if(qcol(label) == 1).alias("pos"), F.count_if(qcol(label) != 1).alias("neg"))
    spark = df.sparkSession
    g = spark.createDataFrame([(i, float(t)) for i, t in enumerate(grid)], "i int, threshold double")
    tot = cnt.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # grid x count table: (len(grid)) x (len(grid)+1) rows at most -- fixed by the grid, not the data
    j = g.join(F.broadcast(cnt), F.col("k") >= F.col("i"), "left").groupBy("i", "threshold").agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"), F.coalesce(F.sum("neg"), F.lit(0)).alias("fp"))
    P = tot.select("P").scalar()
    N = tot.select("N").scalar()
    r = rates_from_counts(N - F.col("fp"), F.col("fp"), P - F.col("tp"), F.col("tp"))
    return j.select("threshold", F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
                    *[F.round(r[m], 6).alias(m) for m in ("f1", "precision", "recall", "accuracy")])


def sweep_best(sweep: DataFrame, metrics: Sequence[str] = ("f1", "precision", "recall", "accuracy")) -> DataFrame:
    """Per metric: best grid threshold (first max = smallest threshold) and its value."""
    parts = []
    for m in metrics:
        parts.append(sweep.where(F.col(m) == sweep.agg(F.max(m)).scalar()).agg(
            F.lit(m).alias("metric"), F.min("threshold").alias("threshold"), F.max(m).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# M10 ------------------------------------------------------------------------------
def score_distribution(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per class: n, mean, population std; separation = |mean1 - mean0| on every row."""
    g = df.groupBy(qcol(label).alias("class")).agg(F.count(F.lit(1)).alias("n"),
                                                   F.avg(qcol(score)).alias("mean"),
                                                   F.stddev_pop(qcol(score)).alias("std"))
    m1 = g.where(F.col("class") == 1).select("mean").scalar()
    m0 = g.where(F.col("class") == 0).select("mean").scalar()
    return g.withColumn("separation", F.abs(m1 - m0))


# M12 ------------------------------------------------------------------------------
def class_distribution(df: DataFrame, label: str = "label", score: str = "score",
                       threshold: float = DEFAULT_THRESHOLD, split: str | None = None) -> DataFrame:
    """Rows ``([split,] kind, class, n, share)`` for actual and predicted classes."""
    keys = [qcol(split)] if split else []
    pred = (qcol(score) >= threshold).cast("int")
    lv = df.select(*keys, F.explode(F.array(F.struct(F.lit("actual").alias("kind"), qcol(label).cast("int").alias("class")),
                                            F.struct(F.lit("predicted").alias("kind"), pred.alias("class")))).alias("_s")) \
        .select(*keys, "_s.*")
    g = lv.groupBy(*keys, "kind", "class").agg(F.count(F.lit(1)).alias("n"))
    tot = lv.groupBy(*keys, "kind").agg(F.count(F.lit(1)).alias("_t"))
    on = ([split] if split else []) + ["kind"]
    return g.join(tot, on).select(*on, "class", "n", F.round(F.col("n") / F.col("_t"), 6).alias("share"))


# M13 ------------------------------------------------------------------------------
def score_histogram(df: DataFrame, label: str = "label", score: str = "score", bins: int = 40) -> DataFrame:
    """Equal-width score bins over each class's own range."""
    from riskframe.operators.explore import histogram
    return histogram(df.select(qcol(label).alias("class"), qcol(score).alias("score")), "score", bins, by=["class"])


# M4 + M5 + M7 from one curve ------------------------------------------------------------
def rank_summary(df: DataFrame, label: str = "label", score: str = "score", weight: str | None = None) -> DataFrame:
    """One row: ROC AUC, average precision, and the best-F1 threshold with its F1, all from ONE curve.

    Descending thresholds t with per-threshold pos(t)/neg(t) and cumulative tp(t)/fp(t):
    AUC = sum neg(t) * (tp(t) - pos(t)/2) / (P N)   (mid-rank Mann-Whitney),
    AP  = sum pos(t) * precision(t) / P,
    best F1 = max over t, smallest threshold on ties (max of struct(f1, -t)).
    """
    c = curve(df, label, score, weight)
    a = c.agg(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)).alias("_auc_num"),
              F.sum(F.col("pos") * F.col("precision")).alias("_ap_num"),
              F.sum("pos").alias("_P"), F.sum("neg").alias("_N"),
              F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("nt"))).alias("_best"))
    return a.select(F.try_divide(F.col("_auc_num"), F.col("_P") * F.col("_N")).alias("roc_auc"),
                    F.try_divide(F.col("_ap_num"), F.col("_P")).alias("average_precision"),
                    (-F.col("_best.nt")).alias("best_threshold"), F.col("_best.f1").alias("best_f1"))


# M2-M5 of many scorings at once -----------------------------------------------------------
def grouped_metrics(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score",
                    weight: str | None = None, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Per group of ``by`` (a fold, a replicate, a candidate, a permuted column): n, accuracy, precision, recall, f1,
    roc_auc, average_precision of the scores in it; weighted where ``weight`` is given.

    One curve for all groups: distinct scores per group, then running sums by descending score inside each group, a group
    that holds more than its share of them being split into ranges like any other key. Nothing is computed per group on
    the driver, and a group with one class has no AUC (null).
    """
    by = list(by)
    sc = score_counts(df, label, score, weight, by).withColumn("_neg_score", -F.col("score"))
    cum = running_sums(sc, ["_neg_score"], {"tp": "pos", "fp": "neg"}, keys=by)
    above = F.col("score") >= threshold
    a = cum.groupBy(*map(qcol, by)).agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
        F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0.0)).alias("_tp"),
        F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0.0)).alias("_fp"),
        F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)).alias("_auc"),
        F.sum(F.try_divide(F.col("pos") * F.col("tp"), F.col("tp") + F.col("fp"))).alias("_ap"))
    r = rates_from_counts(F.col("_n") - F.col("_fp"), F.col("_fp"), F.col("_p") - F.col("_tp"), F.col("_tp"))
    return a.select(*map(qcol, by), (F.col("_p") + F.col("_n")).alias("n"),
                    *[r[m].alias(m) for m in ("accuracy", "precision", "recall", "f1")],
                    F.try_divide(F.col("_auc"), F.col("_p") * F.col("_n")).alias("roc_auc"),
                    F.try_divide(F.col("_ap"), F.col("_p")).alias("average_precision"))
