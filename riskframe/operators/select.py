"""Feature analysis (X1-X11): importances, statistics, selection.

Statistics that are aggregates (ANOVA F, mutual information, VIF from the
correlation matrix, linear Shapley values) are computed relationally in one
pass over the data; model-based ones (permutation, RFE, bootstrap stability,
interaction gain) loop over fits, each fit a distributed job on the same
cached table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.core import hash_order, qcol
from riskframe.operators import metrics as M
from riskframe.operators.models import parallel_map, predict
from riskframe.operators.ordered import rank_within
from riskframe.session import cut_lineage

# --- fixed values --------------------------------------------------------------
VIF_FLAG = 10.0
STABLE_CV, STABLE_RANK_STD = 0.5, 5.0
UNSTABLE_CV, UNSTABLE_RANK_STD = 1.0, 10.0
CV_EPS = 1e-8
PERMUTATION_REPEATS = 10
RFE_MIN_FEATURES = 10
SHAP_ROWS = 1000
STABILITY_RESAMPLES = 20
# --------------------------------------------------------------------------------


def _long(agg: DataFrame, items: list[tuple[str, dict]]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(n).alias("feature"), *[e.alias(k) for k, e in d.items()]) for n, d in items])
    return agg.select(F.explode(arr).alias("_s")).select("_s.*")


# X3 -------------------------------------------------------------------------------
def anova_f(df: DataFrame, columns: Sequence[str], label: str = "target") -> DataFrame:
    """One-way ANOVA F per feature across label classes (one grouped aggregate, then expressions)."""
    aggs = []
    for i, c in enumerate(columns):
        x = qcol(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_samp(x).alias(f"v{i}")]
    g = df.groupBy(qcol(label).alias("_y")).agg(*aggs)
    # deviations from the grand mean, not differences of sums of squares: large values don't cancel
    grand = g.agg(*[(F.sum(F.col(f"n{i}") * F.col(f"m{i}")) / F.sum(f"n{i}")).alias(f"grand{i}") for i in range(len(columns))])
    tot = g.crossJoin(F.broadcast(grand)).agg(
        F.count(F.lit(1)).alias("k"), *[F.sum(f"n{i}").alias(f"N{i}") for i in range(len(columns))],
        *[F.sum(F.col(f"n{i}") * F.pow(F.col(f"m{i}") - F.col(f"grand{i}"), 2)).alias(f"B{i}") for i in range(len(columns))],
        *[F.sum((F.col(f"n{i}") - 1) * F.coalesce(F.col(f"v{i}"), F.lit(0.0))).alias(f"W{i}") for i in range(len(columns))])
    items = []
    for i, c in enumerate(columns):
        N, k = F.col(f"N{i}"), F.col("k")
        f = F.try_divide(F.col(f"B{i}") / (k - 1), F.col(f"W{i}") / (N - k))
        items.append((c, {"f_stat": f, "df_between": (k - 1).cast("double"), "df_within": (N - k).cast("double")}))
    return _long(tot, items)


# X4 -------------------------------------------------------------------------------
def mutual_information(df: DataFrame, columns: Sequence[str], label: str = "target", bins: int | None = None
                       ) -> DataFrame:
    """Discrete MI (nats) between each column and the label: sum p(x,y) ln(p(x,y) / (p(x) p(y))).

    Categorical columns use their values; with ``bins`` numeric columns are cut
    into equal-width bins first (a re-aimed estimator, see README)."""
    src = df
    if bins:
        lo_hi = df.agg(*[F.min(qcol(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)],
                       *[F.max(qcol(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)]).first()
        ex = {}
        for i, c in enumerate(columns):
            lo, hi = lo_hi[f"lo{i}"], lo_hi[f"hi{i}"]
            w = (hi - lo) / bins if hi is not None and hi > lo else 1.0
            ex[c] = F.least(F.floor((qcol(c).cast("double") - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("string")
        src = df.withColumns(ex)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), qcol(c).cast("string").alias("x")) for c in columns])
    lv = src.select(qcol(label).alias("y"), F.explode(arr).alias("_s")).select("_s.feature", "_s.x", "y") \
        .where(F.col("x").isNotNull())
    joint = lv.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("nxy"))
    px = joint.groupBy("feature", "x").agg(F.sum("nxy").alias("nx"))
    py = joint.groupBy("feature", "y").agg(F.sum("nxy").alias("ny"))
    n = joint.groupBy("feature").agg(F.sum("nxy").alias("n"))
    j = joint.join(px, ["feature", "x"]).join(py, ["feature", "y"]).join(n, "feature")
    nxy, n, nx, ny = (F.col(c).cast("double") for c in ("nxy", "n", "nx", "ny"))      # products pass the bigint range
    term = nxy / n * F.log(nxy * n / (nx * ny))
    return j.groupBy("feature").agg(F.sum(term).alias("mutual_info"))


def digamma_of_count(n):
    """psi(n) for counts n >= 1: the recurrence up to n + 8, then the asymptotic series (error below 1e-12)."""
    n = n.cast("double")
    y = n + 8
    s = 1 / (y * y)
    series = F.log(y) - 0.5 / y - s * (1 / 12.0 - s * (1 / 120.0 - s * (1 / 252.0 - s * (1 / 240.0 - s / 132.0))))
    return series - sum((1 / (n + i) for i in range(1, 8)), 1 / n)


def neighbour_information(df: DataFrame, columns: Sequence[str], label: str = "target", neighbours: int = 3) -> DataFrame:
    """X4 for continuous columns: the k-nearest-neighbour estimate of the mutual information (nats, at least 0) between
    each column and a class label; rows (feature, mutual_info).

    A row's radius is the distance to its k-th nearest row of its class (k = ``neighbours``, or one less than the class
    if that is smaller; a class of one row is left out); m counts the rows of any class nearer than that, or equal where
    the radius is 0. I = psi(N) + mean psi(k) - mean psi(class size) - mean psi(m).

    In one dimension the nearest are neighbours in order: every row goes to the k places on either side of its rank in
    its class, so a place meets 2k + 1 rows, whatever the classes' sizes. Counts within a radius come from running counts
    over rows and both ends of all radii in one order. Rank and order are split into ranges when a class is large.
    """
    from riskframe.operators.ordered import running_sums
    from riskframe.operators.quantiles import long_values
    base = long_values(df.where(qcol(label).isNotNull()), columns, [label]).withColumnRenamed(label, "y").where(~F.isnan("v"))
    hist = base.groupBy("column", "y", "v").agg(F.count(F.lit(1)).alias("cnt"))       # equal rows of a class share radius and m
    sizes = hist.groupBy("column", "y").agg(F.sum("cnt").alias("n_y")).where("n_y > 1")
    hist = cut_lineage(hist.join(sizes, ["column", "y"]))
    k = F.least(F.lit(neighbours), F.col("n_y") - 1)
    # a value's neighbours in its class: values up to k places away in the order of distinct values hold the k nearest rows
    order = rank_within(hist, ["column", "y"], ["v"], "place")
    sent = order.select("column", "y", "v", "cnt", F.explode(F.sequence(F.col("place") - neighbours, F.col("place") + neighbours)).alias("at"))
    met = sent.groupBy("column", "y", F.col("at").alias("place")).agg(F.collect_list(F.struct("v", "cnt")).alias("near"))      # 2k + 1 values
    with_near = order.join(met, ["column", "y", "place"]).select("column", "y", "v", "cnt", "n_y", "near", k.alias("k"))
    by_distance = F.array_sort(F.transform("near", lambda e: F.struct(F.abs(e["v"] - F.col("v")).alias("d"), e["cnt"].alias("c"))))
    start = F.struct(F.lit(-1).cast("bigint").alias("seen"), F.lit(None).cast("double").alias("d"))         # the row itself doesn't count
    radius = F.aggregate(by_distance, start, lambda acc, e: F.struct(
        (acc["seen"] + e["c"]).alias("seen"), F.coalesce(acc["d"], F.when(acc["seen"] + e["c"] >= F.col("k"), e["d"])).alias("d")))["d"]
    points = cut_lineage(with_near.withColumn("r", radius).select("column", "y", "v", "cnt", "n_y", "k", "r"))
    # running counts: rows (kind 1) between lower ends (kind 0: rows before) and upper ends (kind 2: rows up to)
    inside = F.col("r") > 0
    ends = points.select("column", "y", "v", F.explode(F.array(
        F.struct((F.col("v") - F.col("r")).alias("at"), F.when(inside, 2).otherwise(0).alias("kind"), F.lit(-1).alias("sign")),
        F.struct((F.col("v") + F.col("r")).alias("at"), F.when(inside, 0).otherwise(2).alias("kind"), F.lit(1).alias("sign")))).alias("e")) \
        .select("column", "y", "v", "e.*").withColumn("cnt", F.lit(0).cast("bigint"))
    rows = points.select("column", "y", "v", F.col("v").alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("sign"), "cnt")
    counted = running_sums(rows.unionByName(ends), ["at", "kind", "y", "v", "sign"], {"upto": "cnt"}, keys=["column"]).where("sign <> 0")
    m = counted.groupBy("column", "y", "v").agg(F.sum(F.col("sign") * F.col("upto")).alias("m"))
    all_ = points.join(m, ["column", "y", "v"])
    w = F.col("cnt")
    a = all_.groupBy("column").agg(F.sum(w).alias("n"), (F.sum(w * (digamma_of_count(F.col("k")) - digamma_of_count(F.col("n_y"))
                                                                   - digamma_of_count(F.col("m")))) / F.sum(w)).alias("mean"))
    return a.select(F.col("column").alias("feature"), F.greatest(F.lit(0.0), digamma_of_count(F.col("n")) + F.col("mean")).alias("mutual_info"))


# X6 -------------------------------------------------------------------------------
def vif(df: DataFrame, columns: Sequence[str] = (), vector: str | None = None) -> DataFrame:
    """VIF_j = [R^-1]_jj from the correlation matrix (one pass; k x k solve on the driver, k = number of features). Singular
    or constant -> infinity. With ``vector`` the slots of a feature vector are the features."""
    from riskframe.operators.blocks import co_moments
    from riskframe.operators.models import feature_names
    names = list(columns) if vector is None else feature_names(df, vector)
    R = co_moments(df, columns, vector).correlations()
    bad = bool(np.isnan(R).any())
    np.fill_diagonal(R, 1.0)
    try:
        if bad or np.linalg.cond(R) > 1e12:
            raise np.linalg.LinAlgError
        diag = np.diag(np.linalg.inv(R)).tolist()
    except np.linalg.LinAlgError:
        diag = [float("inf")] * len(names)
    return df.sparkSession.createDataFrame([(c, float(v), bool(v > VIF_FLAG)) for c, v in zip(names, diag)],
                                           "feature string, vif double, high boolean")


# X9 -------------------------------------------------------------------------------
def linear_shap(df: DataFrame, columns: Sequence[str], coefficients: Sequence[float]) -> DataFrame:
    """Exact Shapley values of a linear model with independent features: coef_j (x_j - mean_j);
    importance = mean |value| per feature (means broadcast as literals from one aggregate)."""
    means = df.agg(*[F.avg(qcol(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    agg = df.agg(*[F.avg(F.abs(F.lit(float(w)) * (qcol(c).cast("double") - F.lit(means[f"m{i}"])))).alias(f"a{i}")
                   for i, (c, w) in enumerate(zip(columns, coefficients))])
    return _long(agg, [(c, {"mean_abs_shap": F.col(f"a{i}")}) for i, c in enumerate(columns)])


# X2 -------------------------------------------------------------------------------
def shuffled_ranks(df: DataFrame, key: str, seed) -> tuple[DataFrame, int]:
    """``df`` with ``_r``, its place in the order of md5(seed:key), written once to the shared folder; and its rows."""
    ranked = cut_lineage(rank_within(df.withColumn("_h", hash_order(seed, qcol(key))), [], ["_h", key], "_r").drop("_h"))
    return ranked, ranked.count()


def permute_column(df: DataFrame, column: str, key: str, seed, ranked: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Exact permutation of one column: each row takes the value of the row some places on in a shuffled order (the
    distance chosen by ``seed``, 1 to rows - 1). ``ranked`` may be shared by many columns and seeds."""
    t, n = ranked or shuffled_ranks(df, key, seed)
    if n < 2:
        return t.drop("_r")
    shift = 1 + int(hashlib.md5(f"{seed}:{column}".encode()).hexdigest(), 16) % (n - 1)
    moved = t.select(F.pmod(F.col("_r") - shift, F.lit(n)).alias("_r"), qcol(column).alias("_v"))
    return t.join(moved, "_r").withColumn(column, F.col("_v")).drop("_r", "_v")


def permutation_importance(model, df: DataFrame, columns: Sequence[str], assemble: Callable, key: str,
                           label: str = "target", repeats: int = PERMUTATION_REPEATS, seed: int = 42) -> DataFrame:
    """Drop in AUC when one raw column is permuted (``assemble`` rebuilds the feature vector); ``df`` should be rows the
    model wasn't fitted on.

    A repeat joins each row once with the row some places on in a shuffled order, whose values of all columns come
    along; each column in turn takes its value from there. All scorings are graded by one curve, grouped by column and
    repeat.
    """
    ranked, n = shuffled_ranks(df, key, seed)
    columns = list(columns)

    def scores(frame, feature, repeat):
        return predict(model, assemble(frame), keep=[label]).select(F.lit(feature).alias("feature"), F.lit(repeat).alias("repeat"), F.col(label), "score")

    def repeated(r):
        shift = 1 + int(hashlib.md5(f"{seed}:{r}".encode()).hexdigest(), 16) % (n - 1) if n > 1 else 0
        moved = ranked.select(F.pmod(F.col("_r") - shift, F.lit(max(1, n))).alias("_r"), *[qcol(c).alias(f"_moved{i}") for i, c in enumerate(columns)])
        both = cut_lineage(ranked.join(moved, "_r"))
        other = ["_r", *[f"_moved{i}" for i in range(len(columns))]]
        return cut_lineage(reduce(DataFrame.unionByName, [scores(both.withColumn(c, F.col(f"_moved{i}")).drop(*other), c, r) for i, c in enumerate(columns)]))
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, importance_mean double, importance_std double")
    parts = parallel_map(repeated, list(range(repeats))) + [scores(df, None, -1)]
    auc = cut_lineage(M.grouped_metrics(reduce(DataFrame.unionByName, parts), ["feature", "repeat"], label, "score").select("feature", "roc_auc"))
    base = auc.where("feature IS NULL").select("roc_auc").scalar()
    return auc.where("feature IS NOT NULL").groupBy("feature").agg(F.avg(base - F.col("roc_auc")).alias("importance_mean"),
                                                                    F.stddev_pop("roc_auc").alias("importance_std"))


# X1 / X11 -------------------------------------------------------------------------
def ranked(long: DataFrame, value: str, method: str, model: str = "") -> DataFrame:
    """(model, method, feature, value, rank) with rank 1 = largest value (ties by name); input is one row
    per feature."""
    w = Window.orderBy(F.desc("value"), F.asc("feature"))      # one row per feature: a small window
    return long.select(F.lit(model).alias("model"), F.lit(method).alias("method"), "feature",
                       F.col(value).cast("double").alias("value")).withColumn("rank", F.row_number().over(w))


def side_by_side(a: DataFrame, b: DataFrame, a_name: str, b_name: str) -> DataFrame:
    """Full outer join of two rankings on feature."""
    return a.select("feature", F.col("value").alias(f"{a_name}_value"), F.col("rank").alias(f"{a_name}_rank")) \
        .join(b.select("feature", F.col("value").alias(f"{b_name}_value"), F.col("rank").alias(f"{b_name}_rank")),
              "feature", "full_outer")


# X5 -------------------------------------------------------------------------------
def rfe_cv(df: DataFrame, features: Sequence[str], importance_fn: Callable, cv_fn: Callable, step=1,
           min_features: int = RFE_MIN_FEATURES) -> tuple[DataFrame, DataFrame]:
    """Recursive elimination: score the current set by CV, drop the ``step`` least important (ties by name).

    ``cv_fn(features)`` gives (mean, std) of the score. Returns the path (n_features, cv_auc, cv_std, features) and the
    verdict per feature (feature, ranking, selected, eliminated_at): the selected set is the smallest with the best
    mean and has ranking 1, the last eliminated before it 2, and so on; eliminated_at is the step at which elimination
    down to ``min_features`` dropped the feature (null: never)."""
    spark = df.sparkSession
    cur, path, gone = list(features), [], []
    while True:
        mean, std = cv_fn(cur)
        path.append((len(cur), float(mean), float(std), ",".join(cur)))
        if len(cur) <= min_features:
            break
        imp = importance_fn(cur)                 # {feature: importance}
        n_drop = step if isinstance(step, int) else max(1, int(len(cur) * step))
        drop = sorted(cur, key=lambda f: (imp.get(f, 0.0), f))[:min(n_drop, len(cur) - min_features)]
        gone.append(drop)
        cur = [f for f in cur if f not in drop]
    best = max(range(len(path)), key=lambda i: (path[i][1], i))
    at = {f: i for i, drop in enumerate(gone) for f in drop}
    rows = [(f, 1 if at.get(f, best) >= best else 1 + best - at[f], at.get(f, best) >= best, at[f] + 1 if f in at else None)
            for f in features]
    return (spark.createDataFrame(path, "n_features int, cv_auc double, cv_std double, features string"),
            spark.createDataFrame(rows, "feature string, ranking int, selected boolean, eliminated_at int"))


# X8 -------------------------------------------------------------------------------
def importance_stability(long: DataFrame) -> DataFrame:
    """Per feature over resamples: mean/std/min/max/CV of importance and mean/std/range of rank; verdict."""
    g = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                    F.min("value").alias("min"), F.max("value").alias("max"),
                                    F.avg("rank").alias("rank_mean"), F.stddev_pop("rank").alias("rank_std"),
                                    (F.max("rank") - F.min("rank")).alias("rank_range"))
    cv = F.col("std") / (F.col("mean") + CV_EPS)
    return g.withColumn("cv", cv).withColumn(
        "verdict", F.when((cv < STABLE_CV) & (F.col("rank_std") < STABLE_RANK_STD), "stable")
        .when((cv > UNSTABLE_CV) | (F.col("rank_std") > UNSTABLE_RANK_STD), "unstable").otherwise("moderate"))


# X7 -------------------------------------------------------------------------------
def interaction_screen(df: DataFrame, columns: Sequence[str], label: str = "target") -> DataFrame:
    """corr(x_a * x_b, y) for all pairs of a short list (one aggregate), upper triangle."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    agg = df.agg(*[F.corr(qcol(a).cast("double") * qcol(b).cast("double"), qcol(label).cast("double")).alias(f"p{i}")
                   for i, (a, b) in enumerate(pairs)])
    arr = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"p{i}").alias("corr"))
                    for i, (a, b) in enumerate(pairs)])
    return agg.select(F.explode(arr).alias("_s")).select("_s.*")


def interaction_gain(df: DataFrame, pairs: Sequence[tuple[str, str]], base: Sequence[str], cv_auc: Callable
                     ) -> DataFrame:
    """CV AUC with the product term added minus the base CV AUC, per pair (sorted by gain)."""
    spark = df.sparkSession
    base_auc = cv_auc(df, list(base))
    rows = []
    for a, b in pairs:
        name = f"{a}_x_{b}"
        with_term = df.withColumn(name, qcol(a).cast("double") * qcol(b).cast("double"))
        auc = cv_auc(with_term, list(base) + [name])
        rows.append((a, b, float(base_auc), float(auc), float(auc - base_auc)))
    return spark.createDataFrame(rows, "feature_a string, feature_b string, base_auc double, auc double, gain double") \
        .orderBy(F.desc("gain"), "feature_a", "feature_b")


def first_by_hash(df: DataFrame, key: str, seed, rows: int) -> DataFrame:
    """The ``rows`` rows that come first by md5(seed:key). Only rows under a bound that leaves little more than these are
    ordered, so a task brings a few rows, not ``rows`` of its own; were the bound too low, all rows would be."""
    h, n = hash_order(seed, qcol(key)), df.count()
    if n > 4 * rows:
        some = df.where(h < math.ceil((rows + 8 * math.sqrt(rows) + 16) / n * (1 << 32)))
        if some.count() >= rows:
            df = some
    return df.orderBy(h, qcol(key)).limit(rows)


def permutation_shap(model, df: DataFrame, key: str, features: str = "features", rows: int = SHAP_ROWS,
                     permutations: int = 8, seed: int = 42) -> DataFrame:
    """Sampled-permutation Shapley values for any vector model (X9 beyond the linear case).

    The ``rows`` rows that come first by hash (the explainer's sample, whatever the size of the table) is crossed with ``permutations`` feature
    orders and d+1 prefix steps; the hybrid vector at step s takes the row's values for the first s
    features of the order and the column means elsewhere. Each hybrid is scored by ``model.transform``;
    the score change between consecutive steps is credited to the feature added. Rows: (feature_index,
    mean_abs_shap, mean_shap, rows_explained). The feature orders are d x permutations numbers built on the driver.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    d = len(df.select(features).first()[0])
    bg = df.select(Summarizer.mean(F.col(features)).alias("m")).first()["m"].toArray().tolist()
    orders = []
    for p in range(permutations):
        idx = sorted(range(d), key=lambda j: hashlib.md5(f"{seed}:{p}:{j}".encode()).hexdigest())
        orders.append(idx)
    pos = [[0] * d for _ in range(permutations)]
    for p, idx in enumerate(orders):
        for r, j in enumerate(idx):
            pos[p][j] = r
    sample = first_by_hash(df, key, f"shap{seed}", rows) \
        .select(F.col(key), vector_to_array(F.col(features)).alias("_x"))
    perm_tab = F.array(*[F.struct(F.lit(p).alias("p"), F.array(*[F.lit(v) for v in pos[p]]).alias("pos"),
                                  F.array(*[F.lit(v) for v in orders[p]]).alias("order"))
                         for p in range(permutations)])
    bg_arr = F.array(*[F.lit(float(v)) for v in bg])
    x = sample.select(key, "_x", F.explode(perm_tab).alias("_perm")) \
        .select(key, "_x", "_perm", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("step"))
    hybrid = F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                         lambda j: F.when(F.element_at(F.col("_perm.pos"), j + 1) < F.col("step"),
                                          F.element_at(F.col("_x"), j + 1))
                         .otherwise(F.element_at(bg_arr, j + 1)))
    h = x.select(key, F.col("_perm.p").alias("p"), F.col("_perm.order").alias("order"), "step",
                 array_to_vector(hybrid).alias(features))
    scored = model.transform(h).select(key, "p", "order", "step",
                                       vector_to_array(F.col("probability")).getItem(1).alias("s"))
    w = Window.partitionBy(key, "p").orderBy("step")              # d+1 rows per (row, permutation)
    delta = scored.withColumn("delta", F.col("s") - F.lag("s").over(w)).where(F.col("step") > 0) \
        .select(key, F.element_at(F.col("order"), F.col("step")).alias("feature_index"), "delta")
    value = delta.groupBy(key, "feature_index").agg(F.avg("delta").alias("value"))         # a row's Shapley value
    return value.groupBy("feature_index").agg(F.avg(F.abs("value")).alias("mean_abs_shap"),
                                              F.avg("value").alias("mean_shap"), F.count("*").alias("rows_explained"))
