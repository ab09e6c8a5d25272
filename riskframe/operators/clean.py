"""Cleaning steps (P1-P16) and entity/duplicate operators.

Every step is ``DataFrame -> DataFrame`` and composes with ``.transform``;
the matching ``*_counts`` functions return one-row (or long) audit frames
computed in a single aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import SENTINEL, is_string_type, normalize_tokens, qcol, NA_TOKENS
from riskframe.operators import ordered

# --- fixed values --------------------------------------------------------------
# Default exclusion code lists (discharge codes meaning "expired" and "transferred"),
# default derived-column names and the long-stay cut-off of the reference.
EXPIRED_CODES = [11, 19, 20, 21]
TRANSFER_CODES = [3, 4, 5, 6, 22, 23, 24]
DROP_INITIAL = ["weight", "payer_code"]
LONG_STAY_DAYS = 7
EXTREME_VALUE = 30
MISSING_LABEL = "missing"
UNKNOWN_LABEL = "unknown"
OTHERS_LABEL = "Others"
# --------------------------------------------------------------------------------


# P1 -------------------------------------------------------------------------------
def derive_target(df: DataFrame, source: str, positive: str = "<30", name: str = "target",
                  trim: bool = True) -> DataFrame:
    """1 when (trimmed) ``source`` equals ``positive``; null and anything else -> 0."""
    v = F.trim(qcol(source)) if trim else qcol(source)
    return df.withColumn(name, F.when(v == positive, F.lit(1)).otherwise(F.lit(0)).cast("int"))


# P2 -------------------------------------------------------------------------------
def _in_list(c: Column, codes: Sequence) -> Column:
    # null codes are never "in" a list (pandas isin semantics): such rows are kept
    return F.coalesce(c.isin(list(codes)), F.lit(False))


def exclude_codes(df: DataFrame, column: str, code_lists: Mapping[str, Sequence]) -> DataFrame:
    cond = F.lit(False)
    for codes in code_lists.values():
        cond = cond | _in_list(qcol(column), codes)
    return df.where(~cond)


def exclusion_counts(df: DataFrame, column: str, code_lists: Mapping[str, Sequence]) -> DataFrame:
    """One row: rows before, rows per reason, rows removed, rows after."""
    any_hit = F.lit(False)
    aggs = [F.count(F.lit(1)).alias("rows_before")]
    for reason, codes in code_lists.items():
        hit = _in_list(qcol(column), codes)
        any_hit = any_hit | hit
        aggs.append(F.count_if(hit).alias(f"removed_{reason}"))
    aggs.append(F.count_if(any_hit).alias("removed_total"))
    aggs.append(F.count_if(~any_hit).alias("rows_after"))
    return df.agg(*aggs)


# P3 -------------------------------------------------------------------------------
def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.drop(*present)


def columns_over_missing(df: DataFrame, threshold: float, sentinel: str | None = SENTINEL) -> list[str]:
    """Threshold mode of P3: names whose missing share (null or sentinel) exceeds ``threshold``."""
    from riskframe.operators.profile import missing_profile
    rows = missing_profile(df, sentinel).where(F.col("missing_pct") > threshold * 100).select("column").collect()
    return [r[0] for r in rows]


# P4 -------------------------------------------------------------------------------
def replace_sentinel(df: DataFrame, labels: Mapping[str, str] | None = None, default: str | None = UNKNOWN_LABEL,
                     sentinel: str = SENTINEL) -> DataFrame:
    """``sentinel`` -> per-column label for listed columns, ``default`` for other strings."""
    labels = dict(labels or {})
    out = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if f.name in labels:
            out.append(F.when(c == sentinel, F.lit(labels[f.name])).otherwise(c).alias(f.name))
        elif default is not None and is_string_type(f.dataType):
            out.append(F.when(c == sentinel, F.lit(default)).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def sentinel_counts(df: DataFrame, columns: Sequence[str] | None = None, sentinel: str = SENTINEL) -> DataFrame:
    """Long rows ``(column, sentinel_count, pct)`` from one aggregate over the string columns."""
    cols = columns or [f.name for f in df.schema.fields if is_string_type(f.dataType)]
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(qcol(c) == sentinel).alias(c) for c in cols])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast("bigint").alias("sentinel_count"))
                                for c in cols]))
    return agg.select("_n", stack.alias("s")).select(
        "s.column", "s.sentinel_count",
        F.round(F.try_divide(F.col("s.sentinel_count") * 100.0, F.col("_n")), 2).alias("pct"))


def normalize_na(df: DataFrame, columns: Sequence[str] | None = None, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """NA-like tokens -> NULL on string columns (scan-time normalisation)."""
    cols = set(columns or [f.name for f in df.schema.fields if is_string_type(f.dataType)])
    return df.select(*[normalize_tokens(qcol(c), tokens).alias(c) if c in cols else qcol(c) for c in df.columns])


# P6 -------------------------------------------------------------------------------
def derive_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(exprs))


def standard_derived(change_col: str = "change", lab_col: str = "num_lab", med_col: str = "num_med",
                     stay_col: str = "time_in_hospital", long_stay_days: int = LONG_STAY_DAYS) -> dict[str, Column]:
    """The reference's three derived columns (flag, sum, long-stay flag); null > k is 0."""
    return {
        "medication_changed": (qcol(change_col) == "Ch").cast("int"),
        "total_procedures": qcol(lab_col) + qcol(med_col),
        "long_stay": F.coalesce(qcol(stay_col) > long_stay_days, F.lit(False)).cast("int"),
    }


# P7 -------------------------------------------------------------------------------
def negative_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: median of the non-negative values and count of negatives."""
    from riskframe.operators.quantiles import quantiles
    nonneg = df.select(*[F.when(qcol(c) >= 0, qcol(c)).alias(c) for c in columns])
    med = quantiles(nonneg, columns, [0.5]).select("column", F.col("value").alias("median"))
    neg = df.agg(*[F.count_if(qcol(c) < 0).alias(c) for c in columns])
    negl = neg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).alias("negatives"))
                                          for c in columns])).alias("s")).select("s.*")
    return negl.join(med, "column", "left")


def repair_negatives(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """value < 0 -> median of the column's values >= 0 (pandas median = linear interpolation).

    Each median is a scalar subquery (exact distributed quantile); the repaired
    columns are double, type-stable whatever the median turns out to be.
    """
    if not columns:
        return df
    from riskframe.operators.quantiles import quantiles
    nonneg = df.select(*[F.when(qcol(c) >= 0, qcol(c)).alias(c) for c in columns])
    q = quantiles(nonneg, columns, [0.5])
    out = {}
    for c in columns:
        med = q.where(F.col("column") == c).select("value").scalar()
        out[c] = F.when(qcol(c) < 0, med).otherwise(qcol(c).cast("double"))
    return df.withColumns(out)


# P8 -------------------------------------------------------------------------------
def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Count rows matching each rule, one aggregate: long rows ``(rule, n)``."""
    agg = df.agg(*[F.count_if(cond).alias(f"_r{i}") for i, cond in enumerate(rules.values())])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("n"))
                                          for i, name in enumerate(rules)])).alias("s")).select("s.*")


def extreme_value_rules(columns: Sequence[str], limit: int = EXTREME_VALUE, days_col: str | None = None
                        ) -> dict[str, Column]:
    rules = {f"{c}>{limit}": qcol(c) > limit for c in columns}
    if days_col:
        rules[f"{days_col}<0"] = qcol(days_col) < 0
    return rules


# P9 -------------------------------------------------------------------------------
def drop_ids_with_twin(df: DataFrame, id_suffix: str = "_id", desc_suffix: str = "_desc") -> DataFrame:
    drop = [c for c in df.columns if c.endswith(id_suffix) and c[: -len(id_suffix)] + desc_suffix in df.columns]
    return df.drop(*drop)


# P10 ------------------------------------------------------------------------------
def near_unique_columns(df: DataFrame, ratio: float = 0.9, approx: bool = False) -> DataFrame:
    """Long rows ``(column, distinct, rows, ratio, near_unique)`` over string/integer columns.

    Exact counts by a two-level count; ``approx=True`` takes HyperLogLog++ estimates, in one aggregate.
    """
    from riskframe.operators.explore import distinct_counts
    from riskframe.functions.core import is_integral_type
    cols = [f.name for f in df.schema.fields if is_string_type(f.dataType) or is_integral_type(f.dataType)]
    if approx:
        agg = df.agg(*[F.approx_count_distinct(qcol(c)).alias(c) for c in cols])
        found = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast("bigint").alias("distinct"))
                                               for c in cols])).alias("s")).select("s.*")
    else:
        found = distinct_counts(df, cols)
    return found.withColumn("rows", df.agg(F.count(F.lit(1))).scalar()).select(
        "column", "distinct", "rows", F.round(F.try_divide(F.col("distinct").cast("double"), F.col("rows")), 6).alias("ratio")) \
        .withColumn("near_unique", F.col("ratio") > ratio)


# P13 ------------------------------------------------------------------------------
def top_n_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent non-null values (ties by value), a frame of at most n rows."""
    return (df.where(qcol(column).isNotNull()).groupBy(qcol(column).alias("value")).agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc("value")).limit(n))


def group_top_n(df: DataFrame, column: str, n: int, other: str = OTHERS_LABEL, name: str | None = None) -> DataFrame:
    """Keep the ``n`` most frequent values, everything else (null too) -> ``other``.

    The top list has at most ``n`` rows (a caller bound), so it is broadcast.
    """
    top = top_n_values(df, column, n).select(F.col("value").alias("_top"))
    out = df.join(F.broadcast(top), qcol(column) == F.col("_top"), "left")
    return out.withColumn(name or column, F.coalesce(F.col("_top"), F.lit(other))).drop("_top")


# P14 ------------------------------------------------------------------------------
def filter_top_n(df: DataFrame, column: str, n: int) -> DataFrame:
    top = top_n_values(df, column, n).select(F.col("value").alias("_top"))
    return df.join(F.broadcast(top), qcol(column) == F.col("_top"), "left_semi")


# W1 -------------------------------------------------------------------------------
def prior_count(df: DataFrame, entity: str, order: str | Sequence[str], name: str = "num_previous_admissions"
                ) -> DataFrame:
    """0-based count of earlier rows of the same entity (skew-safe cumcount)."""
    return ordered.rank_within(df, [entity], order, name)


# W2 -------------------------------------------------------------------------------
def first_per_entity(df: DataFrame, entity: str, order: str | Sequence[str], keep: str = "first") -> DataFrame:
    return ordered.first_per_key(df, [entity], order, keep)


def entity_dedupe_counts(df: DataFrame, entity: str) -> DataFrame:
    """Entities, entities with >1 rows, surplus rows (what W2 removes)."""
    per = df.groupBy(qcol(entity)).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.col("n") > 1).alias("multi_entities"),
                   F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
                   F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"))


# W3 -------------------------------------------------------------------------------
def full_row_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical row (null equals null): one row ``duplicates``."""
    per = df.groupBy(*[qcol(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


# P16 ------------------------------------------------------------------------------
DEFAULT_STEPS = ("target", "exclude", "missing", "consistency", "derive", "dedupe", "lookup")


def clean_pipeline(df: DataFrame, *, entity: str, order: str, label_source: str, code_column: str,
                   code_lists: Mapping[str, Sequence] | None = None, sentinel_labels: Mapping[str, str] | None = None,
                   drop: Sequence[str] = (), negative_columns: Sequence[str] = (), derived: Mapping[str, Column] | None
                   = None, lookups=None, steps: Sequence[str] = DEFAULT_STEPS, positive: str = "<30") -> DataFrame:
    """Configurable cleaning in the reference's fixed order; switches drop steps."""
    from riskframe.operators import lookup as lk
    code_lists = code_lists if code_lists is not None else {"expired": EXPIRED_CODES, "transfer": TRANSFER_CODES}
    out = df
    if "target" in steps:
        out = derive_target(out, label_source, positive)
    if "exclude" in steps:
        out = exclude_codes(out, code_column, code_lists)
    if "missing" in steps:
        out = drop_columns(out, drop)
        out = replace_sentinel(out, sentinel_labels)
    if "consistency" in steps and negative_columns:
        out = repair_negatives(out, negative_columns)
    if "derive" in steps:
        out = prior_count(out, entity, order)
        if derived:
            out = derive_columns(out, derived)
    if "dedupe" in steps:
        out = first_per_entity(out, entity, order)
    if "lookup" in steps and lookups is not None:
        out = lk.apply_lookups(out, lookups)
    return out


def drop_report(df: DataFrame, columns: Sequence[str], sentinel: str | None = SENTINEL) -> DataFrame:
    """P3 audit: for each listed column, whether it exists and its missing pct (null or sentinel)."""
    from riskframe.operators.profile import missing_profile
    present = [c for c in columns if c in df.columns]
    prof = missing_profile(df.select(*[qcol(c) for c in present]), sentinel).select("column", "missing_pct") \
        if present else None
    names = df.sparkSession.createDataFrame([(c, c in df.columns) for c in columns], "column string, present boolean")
    return names.join(prof, "column", "left") if prof is not None else names.withColumn("missing_pct", F.lit(None))


def column_partition(df: DataFrame, exclude: Sequence[str] = (), threshold: int = 50) -> DataFrame:
    """Rows ``(column, kind, distinct, high_cardinality)``; kind numeric or categorical."""
    from riskframe.operators.explore import distinct_counts
    from riskframe.functions.core import is_numeric_type
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    numeric = [f.name for f in fields if is_numeric_type(f.dataType)]
    kind = F.when(F.col("column").isin(numeric), "numeric").otherwise("categorical")
    return distinct_counts(df, [f.name for f in fields]).select("column", kind.alias("kind"), "distinct") \
        .withColumn("high_cardinality", (F.col("kind") == "categorical") & (F.col("distinct") > threshold))
