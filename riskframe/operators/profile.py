"""Validation rules and fused table profiles.

Every profile is ONE aggregate over the input (all columns, all statistics),
turned into long rows with an ``explode`` of structs -- one scan however many
columns are profiled (the reference makes one pass per column per statistic).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.core import SENTINEL, SPECIAL_TOKENS, is_numeric_type, is_string_type, qcol

# --- fixed values --------------------------------------------------------------
MIN_ROWS = 100
IMBALANCE_WARN_RATIO = 10
RATE_LOW, RATE_HIGH = 0.01, 0.99
MISSING_ISSUE_PCT = 10
IQR_FACTOR = 1.5
CATEGORICAL_MAX_DISTINCT = 10
# --------------------------------------------------------------------------------


def _explode_rows(agg: DataFrame, items: Sequence[tuple[str, list[tuple[str, Column]]]]) -> DataFrame:
    """One-row aggregate -> one row per item: [(column_name, [(field, expr_on_agg), ...])]."""
    arr = F.array(*[F.struct(F.lit(name).alias("column"), *[e.alias(f) for f, e in fields]) for name, fields in items])
    return agg.select(F.explode(arr).alias("_s")).select("_s.*")


def _kind(dt) -> str:
    return "numeric" if is_numeric_type(dt) else ("string" if is_string_type(dt) else dt.simpleString())


# B1 -------------------------------------------------------------------------------
def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows ``(column, present)`` for each required name (schema inspection, no job)."""
    have = set(df.columns)
    return df.sparkSession.createDataFrame([(c, c in have) for c in required], "column string, present boolean")


# B2 -------------------------------------------------------------------------------
def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(qcol(key)).alias("distinct_keys")) \
        .withColumn("duplicate_keys", F.col("rows") - F.col("distinct_keys"))


# B3 / B9 --------------------------------------------------------------------------
def domain_violations(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """Rows ``(column, value, n)`` for non-null values outside each column's allowed set.

    All columns in one pass: the listed columns are unpivoted to (column, value)
    and matched against the inline domain table (small: sum of domain sizes).
    """
    spark = df.sparkSession
    dom = spark.createDataFrame([(c, str(v)) for c, vs in domains.items() for v in vs], "column string, value string")
    lv = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value"))
                                       for c in domains])).alias("_s")).select("_s.*").where(F.col("value").isNotNull())
    bad = lv.join(F.broadcast(dom), ["column", "value"], "left_anti")
    return bad.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


# B4 -------------------------------------------------------------------------------
def non_numeric_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, non_numeric)``: non-null values that do not parse as a number."""
    agg = df.agg(*[F.count_if(qcol(c).try_cast("double").isNull() & qcol(c).isNotNull()).alias(f"_{i}")
                   for i, c in enumerate(columns)])
    return _explode_rows(agg, [(c, [("non_numeric", F.col(f"_{i}"))]) for i, c in enumerate(columns)])


# B5 / B10 / B18 rules -------------------------------------------------------------
def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    """Per class: count, share; plus the max/min class ratio on every row."""
    g = df.groupBy(qcol(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").cast("double")).scalar()
    ratio = g.agg(F.try_divide(F.max("n").cast("double"), F.min("n"))).scalar()
    return g.select("class", "n", F.round(F.col("n") / total, 6).alias("share"),
                    F.round(ratio, 6).alias("imbalance_ratio"))


def table_rules(df: DataFrame, target: str = "target", key: str | None = None) -> DataFrame:
    """Rows ``(rule, value, passed)``: min rows, binary target, rate in [1%, 99%], imbalance, unique key."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.count_if(~F.coalesce(qcol(target).isin(0, 1), F.lit(False))).alias("non_binary"),
            F.avg(qcol(target)).alias("rate"),
            F.count_if(qcol(target) == 1).alias("pos"), F.count_if(qcol(target) == 0).alias("neg")]
    if key:
        aggs.append(F.count_distinct(qcol(key)).alias("keys"))
    a = df.agg(*aggs)
    ratio = F.try_divide(F.greatest("pos", "neg").cast("double"), F.least("pos", "neg"))
    items = [
        ("min_rows", F.col("rows").cast("double"), F.col("rows") >= MIN_ROWS),
        ("binary_target", F.col("non_binary").cast("double"), F.col("non_binary") == 0),
        ("rate_in_range", F.round(F.col("rate"), 6), (F.col("rate") >= RATE_LOW) & (F.col("rate") <= RATE_HIGH)),
        ("imbalance_ratio", F.round(ratio, 6), F.coalesce(ratio <= IMBALANCE_WARN_RATIO, F.lit(False))),
    ]
    if key:
        items.append(("unique_key", (F.col("rows") - F.col("keys")).cast("double"), F.col("rows") == F.col("keys")))
    arr = F.array(*[F.struct(F.lit(n).alias("rule"), v.alias("value"), p.alias("passed")) for n, v, p in items])
    return a.select(F.explode(arr).alias("_s")).select("_s.*")


# B6 -------------------------------------------------------------------------------
def missing_profile(df: DataFrame, sentinel: str | None = SENTINEL) -> DataFrame:
    """Rows ``(column, dtype, null_count, sentinel_count, total, missing_pct)`` from one aggregate."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(qcol(f.name).isNull()).alias(f"_z{i}"))
        if sentinel is not None and is_string_type(f.dataType):
            aggs.append(F.count_if(qcol(f.name) == sentinel).alias(f"_s{i}"))
    a = df.agg(*aggs)
    items = []
    for i, f in enumerate(fields):
        s = F.col(f"_s{i}") if sentinel is not None and is_string_type(f.dataType) else F.lit(0).cast("bigint")
        pct = F.round(F.try_divide((F.col(f"_z{i}") + s) * 100.0, F.col("_n")), 2)
        items.append((f.name, [("dtype", F.lit(_kind(f.dataType))), ("null_count", F.col(f"_z{i}")),
                               ("sentinel_count", s), ("total", F.col("_n")), ("missing_pct", pct)]))
    return _explode_rows(a, items)


# B7 -------------------------------------------------------------------------------
def missing_totals(df: DataFrame) -> DataFrame:
    """One row: cells, null cells, null pct, complete rows, columns without nulls."""
    cols = df.columns
    nulls = [F.count_if(qcol(c).isNull()).alias(f"_z{i}") for i, c in enumerate(cols)]
    complete = F.lit(True)
    for c in cols:
        complete = complete & qcol(c).isNotNull()
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(complete).alias("complete_rows"), *nulls)
    tot = sum((F.col(f"_z{i}") for i in range(len(cols))), F.lit(0))
    clean_cols = sum(((F.col(f"_z{i}") == 0).cast("int") for i in range(len(cols))), F.lit(0))
    return a.select((F.col("rows") * len(cols)).alias("cells"), tot.cast("bigint").alias("null_cells"),
                    F.round(F.try_divide(tot * 100.0, F.col("rows") * len(cols)), 2).alias("null_pct"),
                    "complete_rows", clean_cols.cast("bigint").alias("columns_without_nulls"))


def missing_ranking(df: DataFrame, sentinel: str | None = SENTINEL) -> DataFrame:
    """Columns with any missing value, ranked by missing pct (desc), name as tie-break."""
    p = missing_profile(df, sentinel).where(F.col("missing_pct") > 0)
    from pyspark.sql import Window
    w = Window.orderBy(F.desc("missing_pct"), F.asc("column"))   # <= #columns rows
    return p.select("column", "missing_pct", F.row_number().over(w).alias("rank"))


# B8 -------------------------------------------------------------------------------
def special_token_census(df: DataFrame, tokens: Sequence[str] = SPECIAL_TOKENS) -> DataFrame:
    """Rows ``(column, token, n, pct)`` over all string cells (one aggregate)."""
    cols = [f.name for f in df.schema.fields if is_string_type(f.dataType)]
    aggs = [F.count(F.lit(1)).alias("_n")]
    items = []
    for i, c in enumerate(cols):
        for j, t in enumerate(tokens):
            aggs.append(F.count_if(qcol(c) == t).alias(f"_{i}_{j}"))
            items.append((c, t, f"_{i}_{j}"))
    a = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("token"), F.col(k).alias("n")) for c, t, k in items])
    return a.select("_n", F.explode(arr).alias("_s")).where(F.col("_s.n") > 0).select(
        "_s.column", "_s.token", "_s.n", F.round(F.col("_s.n") * 100.0 / F.col("_n"), 2).alias("pct"))


# B11 ------------------------------------------------------------------------------
def missing_patterns(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """Most frequent null-flag patterns over the columns (ties by pattern)."""
    cols = list(columns)
    flags = [qcol(c).isNull().cast("int").alias(f"null_{c}") for c in cols]
    g = df.select(*flags).groupBy(*[f"null_{c}" for c in cols]).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), *[F.asc(f"null_{c}") for c in cols]).limit(top)


# B12 ------------------------------------------------------------------------------
def nulls_per_row(df: DataFrame) -> DataFrame:
    """Rows ``(nulls_in_row, rows, mean)``; mean nulls per row over the whole table."""
    k = sum((qcol(c).isNull().cast("int") for c in df.columns), F.lit(0))
    g = df.select(k.alias("nulls_in_row")).groupBy("nulls_in_row").agg(F.count(F.lit(1)).alias("rows"))
    mean = g.agg(F.sum(F.col("nulls_in_row") * F.col("rows")) / F.sum("rows")).scalar()
    return g.withColumn("mean", mean)


# B13 ------------------------------------------------------------------------------
def value_distribution(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Rows ``(value, n, pct)``; pct of all rows (or of non-null rows when dropna)."""
    src = df.where(qcol(column).isNotNull()) if dropna else df
    total = src.agg(F.count(F.lit(1)).cast("double")).scalar()
    return src.groupBy(qcol(column).alias("value")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("pct", F.round(F.col("n") * 100.0 / total, 4))


# B14 ------------------------------------------------------------------------------
def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    """Rows ``(column, q1, q3, iqr, lower, upper, outliers, outlier_pct)``; strict bounds, pct of all rows."""
    from riskframe.operators.quantiles import quantiles_wide
    q = quantiles_wide(df, columns, [0.25, 0.75], ["q1", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lower", F.col("q1") - factor * F.col("iqr")).withColumn("upper", F.col("q3") + factor * F.col("iqr"))
    # bounds are one row per profiled column: a small broadcast side
    lv = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast("double").alias("v"))
                                       for c in columns])).alias("_s")).select("_s.*")
    j = lv.join(F.broadcast(q), "column")
    cnt = j.groupBy("column").agg(F.count_if((F.col("v") < F.col("lower")) | (F.col("v") > F.col("upper")))
                                  .alias("outliers"), F.count(F.lit(1)).alias("_rows"))
    return q.join(cnt, "column").select("column", "q1", "q3", "iqr", "lower", "upper", "outliers",
                                        F.round(F.col("outliers") * 100.0 / F.col("_rows"), 2).alias("outlier_pct"))


# B15 ------------------------------------------------------------------------------
def quality_score(df: DataFrame, key: str, sentinel: str | None = SENTINEL) -> DataFrame:
    """max(0, 100 - mean(rounded missing pct) - duplicate-key pct)."""
    mp = missing_profile(df, sentinel).agg(F.avg("missing_pct").alias("mean_missing_pct"))
    dup = key_uniqueness(df, key).select((F.col("duplicate_keys") * 100.0 / F.col("rows"))).scalar()
    return mp.withColumn("duplicate_pct", dup).select(
        F.round("mean_missing_pct", 6).alias("mean_missing_pct"), F.round("duplicate_pct", 6).alias("duplicate_pct"),
        F.round(F.greatest(F.lit(0.0), 100 - F.col("mean_missing_pct") - F.col("duplicate_pct")), 6)
        .alias("quality_score"))


# B17 ------------------------------------------------------------------------------
def basic_info(df: DataFrame, entity: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(qcol(entity)).alias("entities")) \
        .withColumn("columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    """Rows ``(column, position, type, non_null, smallest)``: the schema and, from one aggregate for all columns, how many
    values a column holds and the smallest of them as text."""
    cols = df.columns
    a = df.agg(*[F.count(qcol(c)).alias(f"n{i}") for i, c in enumerate(cols)], *[F.min(qcol(c).cast("string")).alias(f"v{i}") for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    return _explode_rows(a, [(c, [("position", F.lit(i + 1)), ("type", F.lit(types[c])), ("non_null", F.col(f"n{i}")), ("smallest", F.col(f"v{i}"))]) for i, c in enumerate(cols)])


def head_rows(df: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """The first ``k`` rows by ``order`` as long rows ``(row, column, value)``, so any table's head has one schema."""
    from riskframe.sources.io import head
    some = head(df, k, order).withColumn("_row", F.row_number().over(Window.orderBy(*[qcol(c) for c in order])))        # k rows
    arr = F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value")) for c in df.columns])
    return some.select(F.col("_row").alias("row"), F.explode(arr).alias("_s")).select("row", "_s.*")


# B18 ------------------------------------------------------------------------------
def validate_table(df: DataFrame, target: str, entity: str) -> DataFrame:
    """Rows ``(check, value, issue)`` for a cleaned table."""
    from riskframe.operators.clean import full_row_duplicates
    cols = df.columns
    nulls = sum((qcol(c).isNull().cast("bigint") for c in cols), F.lit(0))
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.avg(qcol(target)).alias("rate"), F.sum(nulls).alias("nulls"),
               F.count_distinct(qcol(entity)).alias("entities"))
    j = a.withColumn("duplicates", full_row_duplicates(df).scalar())
    miss = F.coalesce(F.try_divide(F.col("nulls") * 100.0, F.col("rows") * len(cols)), F.lit(0.0))
    items = [("rows", F.col("rows").cast("double"), F.col("rows") == 0),
             ("target_rate", F.round("rate", 6), (F.col("rate") < RATE_LOW) | (F.col("rate") > RATE_HIGH)),
             ("missing_pct", F.round(miss, 6), miss > MISSING_ISSUE_PCT),
             ("duplicate_rows", F.col("duplicates").cast("double"), F.col("duplicates") > 0),
             ("entities", F.col("entities").cast("double"), F.lit(False))]
    arr = F.array(*[F.struct(F.lit(n).alias("check"), v.alias("value"), i.alias("issue")) for n, v, i in items])
    return j.select(F.explode(arr).alias("_s")).select("_s.*")


# B19 ------------------------------------------------------------------------------
def before_after(before: DataFrame, after: DataFrame, entity: str, target: str) -> DataFrame:
    """Rows ``(metric, before, after)``: rows, columns, entities, complete-cell pct, target rate, retention."""
    def one(df):
        cells = sum((qcol(c).isNotNull().cast("bigint") for c in df.columns), F.lit(0))
        aggs = [F.count(F.lit(1)).cast("double").alias("rows"), F.count_distinct(qcol(entity)).cast("double")
                .alias("entities"), F.sum(cells).alias("_filled")]
        if target in df.columns:
            aggs.append(F.avg(qcol(target)).alias("rate"))
        else:
            aggs.append(F.lit(None).cast("double").alias("rate"))
        return df.agg(*aggs).select("rows", "entities", F.lit(float(len(df.columns))).alias("columns"),
                                    F.round(F.col("_filled") * 100.0 / (F.col("rows") * len(df.columns)), 6)
                                    .alias("completeness"), F.round("rate", 6).alias("rate"))
    names = ["rows", "columns", "entities", "completeness", "rate"]

    def longf(df, side):
        arr = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("v")) for n in names])
        return one(df).select(F.explode(arr).alias("_s")).select("_s.*", F.lit(side).alias("side"))
    u = longf(before, "before").unionByName(longf(after, "after"))
    out = u.groupBy("metric").agg(F.max(F.when(F.col("side") == "before", F.col("v"))).alias("before"),
                                  F.max(F.when(F.col("side") == "after", F.col("v"))).alias("after"))
    ret = out.where(F.col("metric") == "rows").select(
        F.lit("retention_pct").alias("metric"), F.lit(100.0).alias("before"),
        F.round(F.col("after") * 100.0 / F.col("before"), 6).alias("after"))
    return out.unionByName(ret)


# B20 ------------------------------------------------------------------------------
def feature_summary(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows ``(column, kind, nulls, distinct)``; kind numeric / binary (both 0 and 1, nothing else) / categorical."""
    from riskframe.operators.explore import distinct_counts
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    aggs = []
    for i, f in enumerate(fields):
        c = qcol(f.name)
        other = F.count_if((c != 0) & (c != 1)) if is_numeric_type(f.dataType) else F.lit(-1)
        aggs += [F.count_if(c.isNull()).alias(f"_z{i}"), other.cast("bigint").alias(f"_o{i}")]
    a = _explode_rows(df.agg(*aggs), [(f.name, [("nulls", F.col(f"_z{i}")), ("other", F.col(f"_o{i}"))]) for i, f in enumerate(fields)])
    kind = F.when(F.col("other") < 0, "categorical").when((F.col("distinct") == 2) & (F.col("other") == 0), "binary") \
        .when(F.col("distinct") < CATEGORICAL_MAX_DISTINCT, "categorical").otherwise("numeric")
    return a.join(distinct_counts(df, [f.name for f in fields]), "column").select("column", kind.alias("kind"), "nulls", "distinct")


# B21 ------------------------------------------------------------------------------
def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, count, mean, std, min, q25, q50, q75, max)``; sample std (ddof=1)."""
    from riskframe.operators.quantiles import quantiles_wide
    aggs = []
    for i, c in enumerate(columns):
        x = qcol(c).cast("double")
        aggs += [F.count(x).alias(f"_c{i}"), F.avg(x).alias(f"_m{i}"), F.stddev_samp(x).alias(f"_s{i}"),
                 F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    a = _explode_rows(df.agg(*aggs), [(c, [("count", F.col(f"_c{i}")), ("mean", F.col(f"_m{i}")),
                                           ("std", F.col(f"_s{i}")), ("min", F.col(f"_lo{i}")),
                                           ("max", F.col(f"_hi{i}"))]) for i, c in enumerate(columns)])
    q = quantiles_wide(df, columns, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    return a.join(q, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
