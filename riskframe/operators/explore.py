"""Grouped analytics.

Each operator is one or two aggregates over the input; shares against the
table total use a scalar subquery (``DataFrame.scalar()``), never an
unpartitioned window, so no step funnels the groups through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.core import qcol
from riskframe.operators.lookup import bounded_broadcast
from riskframe.session import cut_lineage


def _not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & qcol(c).isNotNull()
    return cond


# A1 -------------------------------------------------------------------------------
def rate_by(df: DataFrame, by: str | Sequence[str], target: str = "target", dropna: bool = True,
            min_count: int | None = None, digits: int = 6) -> DataFrame:
    """Per group: rows with a target (``n``), mean target (``rate``), share of all rows (``share``).

    pandas drops null group keys; ``dropna=False`` keeps them as a group.
    """
    by = [by] if isinstance(by, str) else list(by)
    src = df.where(_not_null(by)) if dropna else df
    total = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    g = src.groupBy(*[qcol(c) for c in by]).agg(F.count(qcol(target)).alias("n"), F.avg(qcol(target)).alias("_rate"))
    if min_count is not None:
        g = g.where(F.col("n") >= min_count)
    return g.select(*[qcol(c) for c in by], F.col("n"), F.round("_rate", digits).alias("rate"),
                    F.round(F.col("n") / total, digits).alias("share"))


# A2 -------------------------------------------------------------------------------
def top_rates(df: DataFrame, by: str, target: str = "target", k: int = 10) -> DataFrame:
    """A1 sorted by group size (ties by key) and cut to the ``k`` largest groups (a top-k report)."""
    return rate_by(df, by, target).orderBy(F.desc("n"), F.asc(by)).limit(k)


# A4 -------------------------------------------------------------------------------
def rate_pivot(df: DataFrame, index: str, columns: str, values: Sequence[str], target: str = "target",
               digits: int = 6) -> DataFrame:
    """index x columns matrix of mean target; absent cells null. ``values`` are given explicitly
    (no eager discovery job; a bounded, caller-chosen output width)."""
    g = df.where(qcol(index).isNotNull() & qcol(columns).isNotNull())
    return g.groupBy(qcol(index)).pivot(columns, list(values)).agg(F.round(F.avg(qcol(target)), digits))


# A5 -------------------------------------------------------------------------------
def crosstab_margins(df: DataFrame, a: str, b: str, total_label: str = "All") -> DataFrame:
    """Counts of (a, b) plus 'All' margins, via CUBE (nulls in the data are dropped first, as pandas does)."""
    src = df.where(qcol(a).isNotNull() & qcol(b).isNotNull()) \
        .select(qcol(a).cast("string").alias(a), qcol(b).cast("string").alias(b))
    c = src.cube(qcol(a), qcol(b)) \
        .agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    return c.select(F.when(F.col("_ga") == 1, F.lit(total_label)).otherwise(qcol(a)).alias(a),
                    F.when(F.col("_gb") == 1, F.lit(total_label)).otherwise(qcol(b)).alias(b), "n")


# A6 -------------------------------------------------------------------------------
def column_stats(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """Per column: mean, median, smallest mode, sample std, min, max, q1, q3, corr with target."""
    from riskframe.operators.profile import _explode_rows
    from riskframe.operators.quantiles import modes, quantiles_wide
    aggs = []
    for i, c in enumerate(columns):
        x = qcol(c).cast("double")
        aggs += [F.avg(x).alias(f"_m{i}"), F.stddev_samp(x).alias(f"_s{i}"), F.min(x).alias(f"_lo{i}"),
                 F.max(x).alias(f"_hi{i}"), F.corr(x, qcol(target).cast("double")).alias(f"_r{i}")]
    a = _explode_rows(df.agg(*aggs), [(c, [("mean", F.col(f"_m{i}")), ("std", F.col(f"_s{i}")),
                                           ("min", F.col(f"_lo{i}")), ("max", F.col(f"_hi{i}")),
                                           ("corr_target", F.col(f"_r{i}"))]) for i, c in enumerate(columns)])
    q = quantiles_wide(df, columns, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    m = modes(df, columns).select("column", "mode")
    return a.join(q, "column", "left").join(m, "column", "left") \
        .select("column", "mean", "median", "mode", "std", "min", "max", "q1", "q3", "corr_target")


# A7 -------------------------------------------------------------------------------
def class_means(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """Per column: mean among target 0, among target 1, and (m1 - m0) / m0 * 100."""
    from riskframe.operators.profile import _explode_rows
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(F.when(qcol(target) == 0, qcol(c))).alias(f"_a{i}"),
                 F.avg(F.when(qcol(target) == 1, qcol(c))).alias(f"_b{i}")]
    r = _explode_rows(df.agg(*aggs), [(c, [("mean_0", F.col(f"_a{i}")), ("mean_1", F.col(f"_b{i}"))])
                                      for i, c in enumerate(columns)])
    return r.withColumn("pct_diff", F.try_divide((F.col("mean_1") - F.col("mean_0")) * 100.0, F.col("mean_0")))


# A8 -------------------------------------------------------------------------------
def t_test(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """Two-sample pooled-variance t-test per column (class 0 vs class 1), nulls dropped.

    One aggregate gives n, mean and sample variance per class; t and dof are
    expressions; the p-value is computed on the per-column result rows.
    """
    from riskframe.functions.stats import stars, t_p_value
    from riskframe.operators.profile import _explode_rows
    aggs = []
    for i, c in enumerate(columns):
        for k in (0, 1):
            v = F.when(qcol(target) == k, qcol(c).cast("double"))
            aggs += [F.count(v).alias(f"_n{k}_{i}"), F.avg(v).alias(f"_m{k}_{i}"), F.var_samp(v).alias(f"_v{k}_{i}")]
    fields = ["n0", "m0", "v0", "n1", "m1", "v1"]
    r = _explode_rows(df.agg(*aggs), [(c, [(f, F.col(f"_{f[0]}{f[1]}_{i}")) for f in fields])
                                      for i, c in enumerate(columns)])
    dof = F.col("n0") + F.col("n1") - 2
    sp2 = ((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1")) / dof
    t = (F.col("m0") - F.col("m1")) / F.sqrt(sp2 * (1.0 / F.col("n0") + 1.0 / F.col("n1")))
    r = r.select("column", F.col("n0").alias("n_0"), F.col("n1").alias("n_1"), t.alias("t_stat"),
                 dof.cast("bigint").alias("dof"))
    p = t_p_value(F.col("t_stat"), F.col("dof"))
    return r.withColumn("p_value", p).withColumn("stars", stars(F.col("p_value")))


# A9 / A10 / A11 -------------------------------------------------------------------
def target_correlations(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """Rows ``(column, corr, abs_corr)``: Pearson with the target, all columns in one aggregate."""
    from riskframe.operators.profile import _explode_rows
    a = df.agg(*[F.corr(qcol(c).cast("double"), qcol(target).cast("double")).alias(f"_r{i}")
                 for i, c in enumerate(columns)])
    r = _explode_rows(a, [(c, [("corr", F.col(f"_r{i}"))]) for i, c in enumerate(columns)])
    return r.withColumn("abs_corr", F.abs("corr"))


def strongest_predictor(corrs: DataFrame) -> DataFrame:
    """Column with the largest |corr| (ties: first name)."""
    return argmax_group(corrs, "column", "abs_corr")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long pairwise Pearson matrix ``(col_a, col_b, corr)``, nulls left out pair by pair (null: fewer than two rows or no
    variance). One pass makes one block of co-moments for all pairs."""
    from riskframe.operators.blocks import co_moments
    r = co_moments(df, columns).correlations()
    rows = [(a, b, None if np.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def high_correlation_pairs(matrix: DataFrame, columns: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Upper-triangle pairs with |corr| > threshold."""
    pos = {c: i for i, c in enumerate(columns)}
    order = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    return matrix.where((order[F.col("col_a")] < order[F.col("col_b")]) & (F.abs("corr") > threshold))


# A12 / A13 / A14 ------------------------------------------------------------------
def long_categories(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide categorical columns -> rows ``(keep..., column, value)`` (unpivot)."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value")) for c in columns])
    return df.select(*[qcol(k) for k in keep], F.explode(arr).alias("_s")).select(*[qcol(k) for k in keep], "_s.*")


def top_values(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` most frequent non-null values per column (ties by value): rows (column, rank, value, n)."""
    g = long_categories(df, columns).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), "value")       # over distinct values, limited before the shuffle
    return g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("column", "rank", "value", "n")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, distinct)``: exact counts of distinct non-null values, counted per (column, value) and then per
    column, so that rows are reduced before the shuffle and no task holds a column's values."""
    empty = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    values = long_categories(df, columns).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    found = values.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
    return empty.join(found, "column", "left").select("column", F.coalesce("distinct", F.lit(0)).cast("bigint").alias("distinct"))


#: Sketch cells (2^LG_CELLS) of a distinct count, and relative deviations from its estimate that count as possible (about
#: five standard errors of 1.04 / sqrt(cells)).
LG_CELLS, POSSIBLE = 14, 0.045


def distinct_above(df: DataFrame, columns: Sequence[str], threshold: int | None = None, ratio: float | None = None) -> DataFrame:
    """Rows ``(column, above, exact)``: whether a column has more than ``threshold`` distinct non-null values (or more than
    ``ratio`` of the rows). One pass makes a mergeable sketch per column; only columns whose estimate leaves the question
    open are counted exactly (``exact``; null for the others), so only their values are shuffled."""
    cols = list(columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, above boolean, exact long")
    row = df.agg(F.count(F.lit(1)), *[F.hll_sketch_estimate(F.hll_sketch_agg(qcol(c).cast("string"), LG_CELLS)) for c in cols]).first()
    bound = threshold if ratio is None else ratio * row[0]
    open_ = [c for c, n in zip(cols, row[1:]) if abs((n or 0) - bound) <= POSSIBLE * max(n or 0, bound) + 1]
    exact = {r["column"]: r["distinct"] for r in distinct_counts(df, open_).collect()} if open_ else {}       # a row a column
    rows = [(c, bool(exact.get(c, n or 0) > bound), exact.get(c)) for c, n in zip(cols, row[1:])]
    return df.sparkSession.createDataFrame(rows, "column string, above boolean, exact long")


def usage_summary(df: DataFrame, columns: Sequence[str], target: str = "target", none_value: str = "No") -> DataFrame:
    """Per indicator column: users (value != none), usage pct, mean target among users."""
    lv = long_categories(df, columns, [target])
    total = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    used = F.col("value") != none_value
    return lv.groupBy("column").agg(F.count_if(used).alias("users"),
                                    F.avg(F.when(used, qcol(target))).alias("_r")) \
        .select("column", "users", F.round(F.col("users") * 100.0 / total, 6).alias("usage_pct"),
                F.round(F.col("_r") * 100.0, 6).alias("user_rate_pct"))


def summary_correlation(summary: DataFrame, a: str = "usage_pct", b: str = "user_rate_pct") -> DataFrame:
    """Corr of two summary columns, only when there are more than 2 rows."""
    return summary.agg(F.count(F.lit(1)).alias("rows"), F.corr(a, b).alias("_c")) \
        .select("rows", F.when(F.col("rows") > 2, F.col("_c")).alias("corr"))


def rates_by_columns(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """For each listed column, per value: rows, share of rows, mean target."""
    lv = long_categories(df, columns, [target]).where(F.col("value").isNotNull())
    total = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    return lv.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.avg(qcol(target)).alias("_r")) \
        .select("column", "value", "n", F.round(F.col("n") / total, 6).alias("share"),
                F.round("_r", 6).alias("rate"))


def columns_containing(df: DataFrame, text: str) -> list[str]:
    return [c for c in df.columns if text in c.lower()]


# A15 ------------------------------------------------------------------------------
def code_group_rates(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """P15 applied to each code column, then rate per (column, group)."""
    from riskframe.functions.codes import categorize_code
    g = df.select(qcol(target), *[categorize_code(qcol(c)).alias(c) for c in columns])
    return rates_by_columns(g, columns, target)


# A16 ------------------------------------------------------------------------------
def argmax_group(rates: DataFrame, key: str, value: str = "rate") -> DataFrame:
    """The group with the largest ``value`` (ties: smallest key): one row ``(key, value)``."""
    top = rates.agg(F.max(value)).scalar()
    return rates.where(F.col(value) == top).agg(F.min(qcol(key)).alias(key), F.max(value).alias(value))


# A17 ------------------------------------------------------------------------------
def group_gap(df: DataFrame, by: str, split: str, a_value: str, b_value: str, target: str = "target") -> DataFrame:
    """Per ``by`` group: rate where split == a, rate where split == b, |diff| and which is higher (both > 0)."""
    g = df.groupBy(qcol(by)).agg(F.avg(F.when(qcol(split) == a_value, qcol(target))).alias("rate_a"),
                                 F.avg(F.when(qcol(split) == b_value, qcol(target))).alias("rate_b"))
    g = g.where((F.col("rate_a") > 0) & (F.col("rate_b") > 0))
    return g.select(qcol(by), F.round("rate_a", 6).alias("rate_a"), F.round("rate_b", 6).alias("rate_b"),
                    F.round(F.abs(F.col("rate_a") - F.col("rate_b")), 6).alias("gap"),
                    F.when(F.col("rate_a") > F.col("rate_b"), F.lit(a_value)).otherwise(F.lit(b_value))
                    .alias("higher"))


# A18 ------------------------------------------------------------------------------
def label_ratios(df: DataFrame, label: str, negative: str = "NO", early: str = "<30", late: str = ">30") -> DataFrame:
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(qcol(label) != negative).alias("any_event"),
               F.count_if(qcol(label) == early).alias("early"), F.count_if(qcol(label) == late).alias("late"))
    return a.select("rows", "any_event", "early", "late",
                    F.round(F.col("any_event") * 100.0 / F.col("rows"), 6).alias("any_pct"),
                    F.round(F.col("early") * 100.0 / F.col("rows"), 6).alias("early_pct"),
                    F.round(F.try_divide(F.col("early").cast("double"), F.col("late")), 6).alias("early_late_ratio"))


# A19 ------------------------------------------------------------------------------
def histogram(df: DataFrame, column: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between min and max (per ``by`` group); last bin closed. Rows (by..., bin, lo, hi, n)."""
    by = list(by)
    x = qcol(column).cast("double")
    j = df.select(*[qcol(b) for b in by], x.alias("_x")).where(F.col("_x").isNotNull())
    if by:
        rng = j.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))   # one row per group
        j = j.join(bounded_broadcast(cut_lineage(rng)), by)
    else:
        j = j.withColumns({"_lo": j.agg(F.min("_x")).scalar(), "_hi": j.agg(F.max("_x")).scalar()})
    w = (F.col("_hi") - F.col("_lo")) / bins
    raw = F.when(w == 0, F.lit(0)).otherwise(F.floor((F.col("_x") - F.col("_lo")) / w).cast("int"))
    b = F.least(raw, F.lit(bins - 1))
    out = j.withColumn("bin", b).groupBy(*by, "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    return out.select(*by, "bin", (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("lo"),
                      (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("hi"), "n")


def mean_median(df: DataFrame, column: str) -> DataFrame:
    from riskframe.operators.quantiles import quantiles_wide
    m = df.agg(F.avg(qcol(column).cast("double")).alias("mean")).withColumn("column", F.lit(column))
    return m.join(quantiles_wide(df, [column], [0.5], ["median"]), "column")


# A20 ------------------------------------------------------------------------------
def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """Per group: q1, median, q3 and whiskers = extreme values within 1.5 IQR of the box."""
    from riskframe.operators.quantiles import quantiles_wide
    q = quantiles_wide(df, [column], [0.25, 0.5, 0.75], ["q1", "median", "q3"], by=[by])
    x = qcol(column).cast("double")
    j = df.select(qcol(by), x.alias("_x")).where(F.col("_x").isNotNull()).join(bounded_broadcast(cut_lineage(q)), [by])
    iqr = F.col("q3") - F.col("q1")
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(F.col("_x") >= F.col("q1") - 1.5 * iqr, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= F.col("q3") + 1.5 * iqr, F.col("_x"))).alias("whisker_hi"),
        F.count_if((F.col("_x") < F.col("q1") - 1.5 * iqr) | (F.col("_x") > F.col("q3") + 1.5 * iqr)).alias("fliers"))


# A21 ------------------------------------------------------------------------------
# --- fixed values: insight thresholds ------------------------------------------------
RATE_HIGH_PCT, RATE_LOW_PCT = 15, 5
MISSING_HIGH_PCT, MISSING_LOW_PCT = 20, 5
USAGE_HIGH_PCT = 30
CARDINALITY_HIGH = 20
# --------------------------------------------------------------------------------------


def insights(df: DataFrame, target: str, risk_by: str, usage_columns: Sequence[str], category: str,
             numeric: Sequence[str], none_value: str = "No") -> DataFrame:
    """Rule rows ``(rule, value, level)`` from scalar aggregates."""
    cells = sum((qcol(c).isNull().cast("bigint") for c in df.columns), F.lit(0))
    base = df.agg(F.avg(qcol(target)).alias("rate"), F.sum(cells).alias("nulls"), F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(qcol(category)).alias("card"),
                  *[F.count_if(qcol(c) != none_value).alias(f"_u{i}") for i, c in enumerate(usage_columns)])
    rate = F.col("rate") * 100
    miss = F.col("nulls") * 100.0 / (F.col("rows") * len(df.columns))
    rows = [F.struct(F.lit("target_rate_pct").alias("rule"), F.round(rate, 6).alias("value"),
                     F.when(rate > RATE_HIGH_PCT, "high").when(rate < RATE_LOW_PCT, "low").otherwise("normal")
                     .alias("level")),
            F.struct(F.lit("missing_pct").alias("rule"), F.round(miss, 6).alias("value"),
                     F.when(miss > MISSING_HIGH_PCT, "high").when(miss < MISSING_LOW_PCT, "low").otherwise("normal")
                     .alias("level")),
            F.struct(F.lit(f"{category}_cardinality").alias("rule"), F.col("card").cast("double").alias("value"),
                     F.when(F.col("card") > CARDINALITY_HIGH, "high").otherwise("normal").alias("level"))]
    for i, c in enumerate(usage_columns):
        u = F.col(f"_u{i}") * 100.0 / F.col("rows")
        rows.append(F.struct(F.lit(f"{c}_usage_pct").alias("rule"), F.round(u, 6).alias("value"),
                             F.when(u > USAGE_HIGH_PCT, "high").otherwise("normal").alias("level")))
    out = base.select(F.explode(F.array(*rows)).alias("_s")).select("_s.*")
    top = argmax_group(rate_by(df, risk_by, target), risk_by).select(
        F.concat(F.lit(f"top_risk_{risk_by}:"), qcol(risk_by).cast("string")).alias("rule"),
        F.round(F.col("rate") * 100, 6).alias("value"), F.lit("info").alias("level"))
    corr = target_correlations(df, numeric, target)
    best = corr.where(F.col("abs_corr").isNotNull()).orderBy(F.desc("abs_corr"), F.asc("column")).limit(1).select(
        F.concat(F.lit("strongest_predictor:"), F.col("column")).alias("rule"),
        F.round("abs_corr", 6).alias("value"), F.lit("info").alias("level"))
    return out.unionByName(top).unionByName(best)


# A22 ------------------------------------------------------------------------------
def importance_ranking(records: DataFrame, k: int = 15) -> DataFrame:
    """(model, feature, importance) rows -> per feature mean importance and model count, top k."""
    return records.groupBy("feature").agg(F.round(F.avg("importance"), 6).alias("mean_importance"),
                                          F.count(F.lit(1)).alias("models")) \
        .orderBy(F.desc("mean_importance"), F.asc("feature")).limit(k)


# A23 / A24 ------------------------------------------------------------------------
def best_model(metrics: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """Long metrics ``(model, metric, value)`` -> wide per model plus ``is_best`` (max metric; ties: first name)."""
    wide = metrics.groupBy("model").pivot("metric").agg(F.first("value"))
    top = wide.agg(F.max(metric)).scalar()
    first = wide.where(F.col(metric) == top).agg(F.min("model")).scalar()
    return wide.withColumn("is_best", F.coalesce(F.col("model") == first, F.lit(False)))


def band(value: Column, high: float = 0.7, mid: float = 0.6, labels=("good", "fair", "poor")) -> Column:
    return F.when(value >= high, labels[0]).when(value >= mid, labels[1]).otherwise(labels[2])


def stability_grade(cv: Column) -> Column:
    return F.when(cv < 0.05, "A").when(cv < 0.10, "B").otherwise("C")


# A25 ------------------------------------------------------------------------------
def mean_of_rates(rates: DataFrame, status: str, skip: Sequence[str] = ("?",)) -> DataFrame:
    """Unweighted mean of group rates per status value (skipping listed statuses)."""
    return rates.where(~qcol(status).isin(list(skip))).groupBy(qcol(status)) \
        .agg(F.round(F.avg("rate") * 100, 6).alias("mean_rate_pct"), F.count(F.lit(1)).alias("groups"))


# A26 ------------------------------------------------------------------------------
def overall(df: DataFrame, target: str, stay: str) -> DataFrame:
    return df.agg(F.round(F.avg(qcol(target)), 6).alias("rate"), F.sum(qcol(target)).cast("bigint").alias("positives"),
                  F.round(F.avg(qcol(stay)), 6).alias("mean_stay"))
