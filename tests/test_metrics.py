import math
import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as M

# golden confusion matrices (tn, fp, fn, tp) with the reported ratios
GOLDEN = [((6540, 3173, 393, 420), dict(accuracy=0.6612198366, precision=0.1168939605, recall=0.5166051661,
                                        specificity=0.6733244106, npv=0.9433145824)),
          ((8926, 787, 666, 147), dict(accuracy=0.8619608588, precision=0.1573875803, recall=0.1808118081,
                                       specificity=0.9189745702, npv=0.9305671393))]


@pytest.mark.parametrize("cm,expected", GOLDEN)
def test_golden_confusion_ratios(spark, cm, expected):
    df = spark.createDataFrame([cm], "tn long, fp long, fn long, tp long")
    r = M.rates_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    row = df.select(*[v.alias(k) for k, v in r.items()]).first()
    for k, v in expected.items():
        assert row[k] == pytest.approx(v, abs=1e-9)


def _brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    tot = 0.0
    for p in pos:
        for n in neg:
            tot += 1.0 if p > n else 0.5 if p == n else 0.0
    return tot / (len(pos) * len(neg))


def _frame(spark, n=300, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if rnd.random() < 0.3 else 0
        s = round(min(0.99, max(0.0, rnd.random() * 0.6 + 0.3 * y)), 2)     # coarse -> many ties
        rows.append((i, y, s))
    return rows, spark.createDataFrame(rows, "key long, label int, score double")


def test_auc_matches_brute_force_with_ties(spark):
    rows, df = _frame(spark)
    auc = M.roc_auc(df).first()[0]
    assert auc == pytest.approx(_brute_auc([r[1] for r in rows], [r[2] for r in rows]), abs=1e-12)


def test_auc_symmetry(spark):
    rows, df = _frame(spark, seed=5)
    a = M.roc_auc(df).first()[0]
    b = M.roc_auc(df.withColumn("score", -F.col("score"))).first()[0]
    assert a + b == pytest.approx(1.0, abs=1e-12)


def test_auc_split_path_equals_plain(spark, monkeypatch):
    from riskframe.operators import ordered
    rows, df = _frame(spark, n=500, seed=9)
    plain = M.roc_auc(df).first()[0]
    monkeypatch.setattr(ordered, "MIN_HOT_ROWS", 10)
    split = M.roc_auc(df).first()[0]
    assert split == pytest.approx(plain, abs=1e-12)


def test_average_precision_brute_force(spark):
    rows, df = _frame(spark, seed=11)
    ap = M.average_precision(df).first()[0]
    # sklearn definition: sum over distinct thresholds (desc) of (R_n - R_{n-1}) P_n
    P = sum(r[1] for r in rows)
    exp, prev_r = 0.0, 0.0
    for t in sorted({r[2] for r in rows}, reverse=True):
        tp = sum(1 for r in rows if r[2] >= t and r[1] == 1)
        fp = sum(1 for r in rows if r[2] >= t and r[1] == 0)
        rec = tp / P
        exp += (rec - prev_r) * (tp / (tp + fp))
        prev_r = rec
    assert ap == pytest.approx(exp, abs=1e-12)


def test_threshold_sweep_matches_direct_counts(spark):
    rows, df = _frame(spark, seed=13)
    sw = {r["threshold"]: r for r in M.threshold_sweep(df).collect()}
    assert len(sw) == 80
    for t in (0.1, 0.37, 0.5, 0.89):
        tp = sum(1 for r in rows if r[2] >= t and r[1] == 1)
        fp = sum(1 for r in rows if r[2] >= t and r[1] == 0)
        assert (sw[t]["tp"], sw[t]["fp"]) == (tp, fp)


def test_best_f1_first_max_is_smallest_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label int, score double")
    best = M.best_f1_threshold(df).first()
    assert best["threshold"] == 0.7
    assert best["f1"] == pytest.approx(0.8)


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert M.roc_auc(df).first()[0] is None


def test_log_loss_and_brier(spark):
    data = [(1, 0.8), (0, 0.3), (1, 0.6), (0, 0.0)]
    df = spark.createDataFrame(data, "label int, score double")
    r = M.probability_losses(df).first()
    eps = M.LOG_EPS
    exp_ll = -sum(y * math.log(max(p, eps)) + (1 - y) * math.log(1 - min(p, 1 - eps)) for y, p in data) / 4
    assert r["log_loss"] == pytest.approx(exp_ll)
    assert r["brier"] == pytest.approx(sum((p - y) ** 2 for y, p in data) / 4)
