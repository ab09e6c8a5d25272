import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.core import POISSON1_CDF
from riskframe.operators import select as X
from riskframe.operators import validate as V


@pytest.fixture()
def data(spark):
    rnd = random.Random(21)
    rows = []
    for i in range(400):
        y = 1 if rnd.random() < 0.3 else 0
        a = rnd.gauss(1.0 * y, 1.0)
        b = 2 * a + rnd.gauss(0, 0.5)
        c = rnd.gauss(0, 1)
        cat = rnd.choice(["p", "q", "r"]) if y == 0 else rnd.choice(["p", "p", "q"])
        rows.append((i, y, a, b, c, cat))
    return rows, spark.createDataFrame(rows, "key long, target int, a double, b double, c double, cat string")


def test_anova_f_matches_numpy(spark, data):
    rows, df = data
    got = {r["feature"]: r["f_stat"] for r in X.anova_f(df, ["a", "c"]).collect()}
    for j, name in ((2, "a"), (4, "c")):
        groups = [np.array([r[j] for r in rows if r[1] == k]) for k in (0, 1)]
        allv = np.concatenate(groups)
        ssb = sum(len(g) * (g.mean() - allv.mean()) ** 2 for g in groups)
        ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
        f = (ssb / 1) / (ssw / (len(allv) - 2))
        assert got[name] == pytest.approx(f, rel=1e-9)


def test_mutual_information_matches_counts(spark, data):
    rows, df = data
    got = X.mutual_information(df, ["cat"]).first()["mutual_info"]
    n = len(rows)
    from collections import Counter
    nxy = Counter((r[5], r[1]) for r in rows)
    nx = Counter(r[5] for r in rows)
    ny = Counter(r[1] for r in rows)
    exp = sum(c / n * math.log(c * n / (nx[x] * ny[y])) for (x, y), c in nxy.items())
    assert got == pytest.approx(exp, rel=1e-9)


def test_vif_two_and_three_columns(spark, data):
    rows, df = data
    v2 = {r["feature"]: r["vif"] for r in X.vif(df, ["a", "c"]).collect()}
    r = np.corrcoef([x[2] for x in rows], [x[4] for x in rows])[0, 1]
    assert v2["a"] == pytest.approx(1 / (1 - r * r), rel=1e-9)
    R = np.corrcoef(np.array([[x[2], x[3], x[4]] for x in rows]).T)
    v3 = {r["feature"]: r["vif"] for r in X.vif(df, ["a", "b", "c"]).collect()}
    assert [v3[k] for k in ("a", "b", "c")] == pytest.approx(np.diag(np.linalg.inv(R)).tolist(), rel=1e-6)


def test_vif_collinear_is_infinite(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i % 3)) for i in range(20)], "x double, y double, z double")
    assert all(math.isinf(r["vif"]) for r in X.vif(df, ["x", "y", "z"]).collect())


def test_permute_column_is_a_permutation(spark, data):
    rows, df = data
    p = X.permute_column(df, "a", "key", "s1")
    assert p.count() == len(rows)
    assert sorted(r[0] for r in p.select("a").collect()) == sorted(r[2] for r in rows)
    moved = p.join(df.select("key", F.col("a").alias("a0")), "key").where(F.col("a") != F.col("a0")).count()
    assert moved > len(rows) * 0.9


def test_metric_bootstrap_matches_python(spark, data):
    rows, df = data
    scored = df.withColumn("score", F.when(F.col("a") > 0.5, 0.9).otherwise(0.1)).withColumnRenamed("target", "label")
    reps = {r["replicate"]: r for r in V.metric_bootstrap(scored, "key", 3).collect()}
    import hashlib

    def pois(u):
        for k, p in enumerate(POISSON1_CDF):
            if u < p:
                return k
        return len(POISSON1_CDF)
    for b in range(3):
        num = den = 0.0
        for r in rows:
            u = int(hashlib.md5(f"42:{b}:{r[0]}".encode()).hexdigest()[:8], 16) / 2 ** 32
            w = pois(u)
            pred = 1 if r[2] > 0.5 else 0
            den += w
            num += w * (pred == r[1])
        assert reps[b]["accuracy"] == pytest.approx(num / den, rel=1e-12)


def test_importance_stability_verdicts(spark):
    long = spark.createDataFrame([("f1", 1.0, 1), ("f1", 1.1, 1), ("f2", 0.1, 2), ("f2", 0.9, 2)],
                                 "feature string, value double, rank int")
    got = {r["feature"]: r["verdict"] for r in X.importance_stability(long).collect()}
    assert got["f1"] == "stable" and got["f2"] == "moderate"


def test_summarize_cv_population_std(spark):
    per = spark.createDataFrame([(0, "test", "auc", 0.6), (1, "test", "auc", 0.7), (2, "test", "auc", 0.8)],
                                "fold int, side string, metric string, value double")
    r = V.summarize_cv(per).first()
    assert r["mean"] == pytest.approx(0.7) and r["std"] == pytest.approx(np.std([0.6, 0.7, 0.8]))


def test_permutation_shap_is_efficient(spark, data):
    """Shapley efficiency: the per-feature mean contributions add up to mean f(x) - f(background)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    from riskframe.functions.core import hash_order
    rows, df = data
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    m = LogisticRegression(labelCol="target", maxIter=20).fit(v)
    shap = X.permutation_shap(m, v, "key", rows=40, permutations=3)
    total = sum(r["mean_shap"] for r in shap.collect())
    bg = v.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray().tolist()
    sample = v.orderBy(hash_order("shap42", F.col("key")), "key").limit(40)
    fx = m.transform(sample).select(vector_to_array("probability")[1].alias("p")).agg(F.avg("p")).first()[0]
    bgdf = spark.createDataFrame([(bg,)], "x array<double>").select(array_to_vector("x").alias("features"))
    fb = m.transform(bgdf).select(vector_to_array("probability")[1]).first()[0]
    assert shap.count() == 3 and total == pytest.approx(fx - fb, abs=1e-9)


def test_rfe_path_ranking_and_elimination_order(spark):
    weight = {"a": 3.0, "b": 2.0, "c": 1.0, "d": 0.5}
    score = {4: 0.70, 3: 0.80, 2: 0.75}
    path, verdict = X.rfe_cv(spark.range(1), list(weight), lambda cols: weight, lambda cols: (score[len(cols)], 0.01), min_features=2)
    assert [(r["n_features"], r["cv_auc"], r["cv_std"]) for r in path.collect()] == [(4, 0.70, 0.01), (3, 0.80, 0.01), (2, 0.75, 0.01)]
    got = {r["feature"]: (r["ranking"], r["selected"], r["eliminated_at"]) for r in verdict.collect()}
    assert got == {"a": (1, True, None), "b": (1, True, None), "c": (1, True, 2), "d": (2, False, 1)}


def test_penalty_follows_the_fitted_rows(spark, data):
    """C weighs the summed loss: a table and ten copies of it need the same C / 10 for the same coefficients."""
    from pyspark.ml.feature import VectorAssembler
    from riskframe.operators.models import logistic
    _, df = data
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).withColumn("weight", F.lit(1.0))
    ten = v.withColumn("weight", F.lit(10.0))
    one_fit = logistic(C=0.5).fit(v).coefficients.toArray()
    ten_fit = logistic(C=0.05).fit(ten).coefficients.toArray()
    assert np.allclose(one_fit, ten_fit, atol=1e-6)
    assert not np.allclose(one_fit, logistic(C=0.5).fit(ten).coefficients.toArray(), atol=1e-6)


def test_verdict_levels(spark):
    s = spark.createDataFrame([("test", "m", 0.70, 0.07, 0.1), ("train", "m", 0.80, 0.0, 0.0), ("test", "q", 0.5, 0.2, 0.4)],
                              "side string, metric string, mean double, std double, stability double")
    got = {r["metric"]: tuple(r)[3:] for r in V.verdicts(s).collect()}
    assert got == {"m": ("low", "moderately variable", "moderate"), "q": ("low", "highly variable", None)}


def test_permutation_importance_finds_the_informative_column(spark, data):
    from pyspark.ml.feature import VectorAssembler
    from riskframe.operators.models import logistic
    df = spark.range(400).selectExpr("id AS key", "CAST(id % 2 AS INT) AS target", "CAST(id % 2 AS DOUBLE) AS a",
                                     "CAST(hash(id) % 100 AS DOUBLE) / 100 AS b")
    va = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    m = logistic(weight=None).fit(va.transform(df))
    got = {r["feature"]: r["importance_mean"] for r in
           X.permutation_importance(m, df, ["a", "b"], va.transform, "key", repeats=2).collect()}
    assert got["a"] > 0.3 > abs(got["b"])
