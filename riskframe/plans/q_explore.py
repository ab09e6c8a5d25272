"""Queries for grouped analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.codes import categorize_code_sql
from riskframe.operators import explore
from riskframe.plans.base import clean_enc, clean_sql, q
from riskframe.plans.enc import DIAG_COLUMNS, MED_COLUMNS
from riskframe.plans.registry import register

NUM = ["time_in_hospital", "num_lab", "num_med", "num_proc", "total_procedures"]
C = '"column"'


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# A1
@register("a1_rate_by_category", clean_sql(
    "SELECT age, count(target) AS n, round(avg(target), 6) AS rate, round(count(target) / (SELECT count(*) FROM clean), 6)"
    " AS share FROM clean WHERE age IS NOT NULL GROUP BY age"))
def a1(spark, sf):
    return explore.rate_by(clean_enc(spark, sf), "age")


# A2 (top-k report over the looked-up description)
@register("a2_top_descriptions", clean_sql(
    "SELECT disposition_desc, count(target) AS n, round(avg(target), 6) AS rate, "
    "round(count(target) / (SELECT count(*) FROM clean), 6) AS share FROM clean GROUP BY disposition_desc "
    "ORDER BY n DESC, disposition_desc LIMIT 10"))
def a2(spark, sf):
    return explore.top_rates(clean_enc(spark, sf), "disposition_desc", k=10)


# A3
@register("a3_two_key_rates", clean_sql(
    "SELECT race, age, count(target) AS n, round(avg(target), 6) AS rate, "
    "round(count(target) / (SELECT count(*) FROM clean), 6) AS share FROM clean "
    "WHERE race IS NOT NULL AND age IS NOT NULL GROUP BY race, age HAVING count(target) >= 20"))
def a3(spark, sf):
    return explore.rate_by(clean_enc(spark, sf), ["race", "age"], min_count=20)


# A4
_A4_VALUES = ["F", "O", "P"]


@register("a4_rate_pivot", clean_sql(
    "SELECT race, " + ", ".join(f"round(avg(target) FILTER (WHERE gender = '{v}'), 6) AS \"{v}\"" for v in _A4_VALUES) +
    " FROM clean WHERE race IS NOT NULL AND gender IS NOT NULL GROUP BY race"))
def a4(spark, sf):
    return explore.rate_pivot(clean_enc(spark, sf), "race", "gender", _A4_VALUES)


# A5
@register("a5_crosstab_margins", clean_sql(
    "SELECT CASE WHEN grouping(race) = 1 THEN 'All' ELSE CAST(race AS VARCHAR) END AS race, "
    "CASE WHEN grouping(target) = 1 THEN 'All' ELSE CAST(target AS VARCHAR) END AS target, count(*) AS n "
    "FROM clean WHERE race IS NOT NULL AND target IS NOT NULL GROUP BY CUBE (race, target)"))
def a5(spark, sf):
    return explore.crosstab_margins(clean_enc(spark, sf), "race", "target")


# A6
def _a6_sql():
    parts = []
    for c in NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS {C}, avg({x}) AS mean, quantile_cont({x}, 0.5) AS median, "
            f"(SELECT min(v) FROM (SELECT {x} AS v, count(*) AS k FROM clean WHERE {c} IS NOT NULL GROUP BY 1) "
            f"WHERE k = (SELECT max(k) FROM (SELECT count(*) AS k FROM clean WHERE {c} IS NOT NULL GROUP BY {c}))) AS mode, "
            f"stddev_samp({x}) AS std, min({x}) AS min, max({x}) AS max, quantile_cont({x}, 0.25) AS q1, "
            f"quantile_cont({x}, 0.75) AS q3, corr({x}, CAST(target AS DOUBLE)) AS corr_target FROM clean")
    return clean_sql(_union(parts))


@register("a6_column_stats", _a6_sql())
def a6(spark, sf):
    return explore.column_stats(clean_enc(spark, sf), NUM)


# A7
@register("a7_class_means", clean_sql(_union([
    f"SELECT '{c}' AS {C}, avg({c}) FILTER (WHERE target = 0) AS mean_0, avg({c}) FILTER (WHERE target = 1) AS mean_1, "
    f"(avg({c}) FILTER (WHERE target = 1) - avg({c}) FILTER (WHERE target = 0)) * 100.0 / "
    f"nullif(avg({c}) FILTER (WHERE target = 0), 0) AS pct_diff FROM clean" for c in NUM])))
def a7(spark, sf):
    return explore.class_means(clean_enc(spark, sf), NUM)


# A8 (t and dof exact; p-value from the incomplete beta -- checked by rows)
@register("a8_t_test")
def a8(spark, sf):
    return explore.t_test(clean_enc(spark, sf), NUM)


@register("a8_t_statistic", clean_sql(_union([
    f"SELECT '{c}' AS {C}, n0 AS n_0, n1 AS n_1, (m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * "
    f"(1.0 / n0 + 1.0 / n1)) AS t_stat, CAST(n0 + n1 - 2 AS BIGINT) AS dof FROM (SELECT "
    f"count({c}) FILTER (WHERE target = 0) AS n0, avg(CAST({c} AS DOUBLE)) FILTER (WHERE target = 0) AS m0, "
    f"var_samp(CAST({c} AS DOUBLE)) FILTER (WHERE target = 0) AS v0, count({c}) FILTER (WHERE target = 1) AS n1, "
    f"avg(CAST({c} AS DOUBLE)) FILTER (WHERE target = 1) AS m1, var_samp(CAST({c} AS DOUBLE)) FILTER (WHERE target = 1) "
    f"AS v1 FROM clean)" for c in NUM])))
def a8t(spark, sf):
    return explore.t_test(clean_enc(spark, sf), NUM).drop("p_value", "stars")


# A9
@register("a9_target_correlations", clean_sql(_union([
    f"SELECT '{c}' AS {C}, corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE)) AS corr, "
    f"abs(corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE))) AS abs_corr FROM clean" for c in NUM])))
def a9(spark, sf):
    return explore.target_correlations(clean_enc(spark, sf), NUM)


@register("a9_strongest_predictor", clean_sql(
    "SELECT min(" + C + ") AS " + C + ", max(abs_corr) AS abs_corr FROM (" + _union([
        f"SELECT '{c}' AS {C}, abs(corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE))) AS abs_corr FROM clean"
        for c in NUM]) + ") t WHERE abs_corr = (SELECT max(abs_corr) FROM (" + _union([
            f"SELECT abs(corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE))) AS abs_corr FROM clean" for c in NUM]) + "))"))
def a9s(spark, sf):
    return explore.strongest_predictor(explore.target_correlations(clean_enc(spark, sf), NUM))


# A10 / A11
def _pairs_sql(filter_upper: bool):
    parts = []
    for i, a in enumerate(NUM):
        for j, b in enumerate(NUM):
            if filter_upper and not i < j:
                continue
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr "
                         f"FROM clean")
    body = _union(parts)
    return clean_sql(f"SELECT * FROM ({body}) WHERE abs(corr) > 0.8" if filter_upper else body)


@register("a10_correlation_matrix", _pairs_sql(False))
def a10(spark, sf):
    return explore.correlation_matrix(clean_enc(spark, sf), NUM)


@register("a11_high_correlation_pairs", _pairs_sql(True))
def a11(spark, sf):
    m = explore.correlation_matrix(clean_enc(spark, sf), NUM)
    return explore.high_correlation_pairs(m, NUM, 0.8)


# A12 / A13
def _a12_sql():
    return _union([f"SELECT '{c}' AS {C}, count(*) FILTER (WHERE {q(c)} <> 'No') AS users, "
                   f"round(count(*) FILTER (WHERE {q(c)} <> 'No') * 100.0 / count(*), 6) AS usage_pct, "
                   f"round(avg(target) FILTER (WHERE {q(c)} <> 'No') * 100.0, 6) AS user_rate_pct FROM clean"
                   for c in MED_COLUMNS])


@register("a12_usage_summary", clean_sql(_a12_sql()))
def a12(spark, sf):
    return explore.usage_summary(clean_enc(spark, sf), MED_COLUMNS)


@register("a12_top_values", clean_sql(
    "SELECT \"column\", CAST(rank AS INTEGER) AS rank, value, n FROM (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) AS rank "
    "FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {q(c)} AS value, count(*) AS n FROM clean WHERE {q(c)} IS NOT NULL GROUP BY {q(c)}"
                                  for c in MED_COLUMNS + ["race", "age", "specialty"]) + ")) WHERE rank <= 5"))
def a12t(spark, sf):
    return explore.top_values(clean_enc(spark, sf), MED_COLUMNS + ["race", "age", "specialty"])


@register("a13_summary_correlation", clean_sql(
    f"SELECT count(*) AS rows, CASE WHEN count(*) > 2 THEN corr(usage_pct, user_rate_pct) END AS corr FROM ({_a12_sql()})"))
def a13(spark, sf):
    return explore.summary_correlation(explore.usage_summary(clean_enc(spark, sf), MED_COLUMNS))


# A14
_CHANGE = ["change", "medication_changed"]


@register("a14_rates_by_change_columns", clean_sql(
    f"SELECT {C}, value, count(*) AS n, round(count(*) / (SELECT count(*) FROM clean), 6) AS share, "
    f"round(avg(target), 6) AS rate FROM (" + _union(
        [f"SELECT '{c}' AS {C}, CAST({c} AS VARCHAR) AS value, target FROM clean" for c in _CHANGE]) +
    f") WHERE value IS NOT NULL GROUP BY {C}, value"))
def a14(spark, sf):
    c = clean_enc(spark, sf)
    return explore.rates_by_columns(c, explore.columns_containing(c, "change"))


# A15
@register("a15_code_group_rates", clean_sql(
    f"SELECT {C}, value, count(*) AS n, round(count(*) / (SELECT count(*) FROM clean), 6) AS share, "
    f"round(avg(target), 6) AS rate FROM (" + _union(
        [f"SELECT '{c}' AS {C}, {categorize_code_sql(c)} AS value, target FROM clean" for c in DIAG_COLUMNS]) +
    f") WHERE value IS NOT NULL GROUP BY {C}, value"))
def a15(spark, sf):
    return explore.code_group_rates(clean_enc(spark, sf), DIAG_COLUMNS)


@register("a15_code_pair_rates", clean_sql(
    f"SELECT g1, g2, count(target) AS n, round(avg(target), 6) AS rate, "
    f"round(count(target) / (SELECT count(*) FROM clean), 6) AS share FROM (SELECT {categorize_code_sql('diag_1')} AS g1, "
    f"{categorize_code_sql('diag_2')} AS g2, target FROM clean) GROUP BY g1, g2 HAVING count(target) >= 50"))
def a15p(spark, sf):
    from riskframe.functions.codes import categorize_code
    c = clean_enc(spark, sf).select(categorize_code(F.col("diag_1")).alias("g1"),
                                    categorize_code(F.col("diag_2")).alias("g2"), "target")
    return explore.rate_by(c, ["g1", "g2"], min_count=50)


# A16
@register("a16_highest_risk_group", clean_sql(
    "SELECT min(age) AS age, max(rate) AS rate FROM (SELECT age, round(avg(target), 6) AS rate FROM clean "
    "WHERE age IS NOT NULL GROUP BY age) WHERE rate = (SELECT max(round(avg_t, 6)) FROM (SELECT avg(target) AS avg_t "
    "FROM clean WHERE age IS NOT NULL GROUP BY age))"))
def a16(spark, sf):
    return explore.argmax_group(explore.rate_by(clean_enc(spark, sf), "age"), "age")


# A17
@register("a17_group_gap", clean_sql(
    "SELECT specialty, round(ra, 6) AS rate_a, round(rb, 6) AS rate_b, round(abs(ra - rb), 6) AS gap, "
    "CASE WHEN ra > rb THEN 'F' ELSE 'O' END AS higher FROM (SELECT specialty, avg(target) FILTER (WHERE gender = 'F') "
    "AS ra, avg(target) FILTER (WHERE gender = 'O') AS rb FROM clean GROUP BY specialty) WHERE ra > 0 AND rb > 0"))
def a17(spark, sf):
    return explore.group_gap(clean_enc(spark, sf), "specialty", "gender", "F", "O")


# A18
@register("a18_label_ratios", clean_sql(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE readmitted <> 'NO') AS any_event, "
    "count(*) FILTER (WHERE readmitted = '<30') AS early, count(*) FILTER (WHERE readmitted = '>30') AS late, "
    "round(count(*) FILTER (WHERE readmitted <> 'NO') * 100.0 / count(*), 6) AS any_pct, "
    "round(count(*) FILTER (WHERE readmitted = '<30') * 100.0 / count(*), 6) AS early_pct, "
    "round(CAST(count(*) FILTER (WHERE readmitted = '<30') AS DOUBLE) / "
    "nullif(count(*) FILTER (WHERE readmitted = '>30'), 0), 6) AS early_late_ratio FROM clean"))
def a18(spark, sf):
    return explore.label_ratios(clean_enc(spark, sf), "readmitted")


# A19
@register("a19_histogram", clean_sql("""
SELECT bin, lo0 + bin * (hi0 - lo0) / 30 AS lo, lo0 + (bin + 1) * (hi0 - lo0) / 30 AS hi, count(*) AS n FROM (
  SELECT CAST(CASE WHEN hi0 = lo0 THEN 0 ELSE least(floor((x - lo0) / ((hi0 - lo0) / 30)), 29) END AS INTEGER) AS bin,
         lo0, hi0
  FROM (SELECT CAST(num_med AS DOUBLE) AS x FROM clean WHERE num_med IS NOT NULL),
       (SELECT min(CAST(num_med AS DOUBLE)) AS lo0, max(CAST(num_med AS DOUBLE)) AS hi0 FROM clean))
GROUP BY bin, lo0, hi0"""))
def a19(spark, sf):
    return explore.histogram(clean_enc(spark, sf), "num_med", 30)


# A20
@register("a20_box_stats", clean_sql("""
SELECT target, q1, median, q3,
  min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1)) AS whisker_lo, max(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS fliers
FROM (SELECT target, CAST(num_med AS DOUBLE) AS x FROM clean WHERE num_med IS NOT NULL) d
JOIN (SELECT target, quantile_cont(CAST(num_med AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(num_med AS DOUBLE), 0.5) AS median,
             quantile_cont(CAST(num_med AS DOUBLE), 0.75) AS q3 FROM clean WHERE num_med IS NOT NULL GROUP BY target) qq
USING (target) GROUP BY target, q1, median, q3"""))
def a20(spark, sf):
    return explore.box_stats(clean_enc(spark, sf), "num_med", "target")


# A21 rule rows from scalar aggregates
def _a21_sql():
    from riskframe.plans.base import CLEAN_COLUMNS
    nulls = " + ".join(f"count(*) FILTER (WHERE {q(c)} IS NULL)" for c in CLEAN_COLUMNS)
    corr = _union([f"SELECT '{c}' AS col, abs(corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE))) AS a FROM clean"
                   for c in NUM])
    usage = "\nUNION ALL\n".join(
        f"SELECT '{m}_usage_pct', round(count(*) FILTER (WHERE {m} <> 'No') * 100.0 / count(*), 6), "
        f"CASE WHEN count(*) FILTER (WHERE {m} <> 'No') * 100.0 / count(*) > 30 THEN 'high' ELSE 'normal' END FROM clean"
        for m in ("insulin", "metformin"))
    return clean_sql(f"""
SELECT 'target_rate_pct' AS rule, round(avg(target) * 100, 6) AS value,
       CASE WHEN avg(target) * 100 > 15 THEN 'high' WHEN avg(target) * 100 < 5 THEN 'low' ELSE 'normal' END AS level
FROM clean
UNION ALL
SELECT 'missing_pct', round(({nulls}) * 100.0 / (count(*) * {len(CLEAN_COLUMNS)}), 6),
       CASE WHEN ({nulls}) * 100.0 / (count(*) * {len(CLEAN_COLUMNS)}) > 20 THEN 'high'
            WHEN ({nulls}) * 100.0 / (count(*) * {len(CLEAN_COLUMNS)}) < 5 THEN 'low' ELSE 'normal' END FROM clean
UNION ALL
SELECT 'specialty_cardinality', CAST(count(DISTINCT specialty) AS DOUBLE),
       CASE WHEN count(DISTINCT specialty) > 20 THEN 'high' ELSE 'normal' END FROM clean
UNION ALL
{usage}
UNION ALL
SELECT 'top_risk_age:' || min(age), round(max(rate) * 100, 6), 'info' FROM (
  SELECT age, round(avg(target), 6) AS rate FROM clean WHERE age IS NOT NULL GROUP BY age)
  WHERE rate = (SELECT max(round(r, 6)) FROM (SELECT avg(target) AS r FROM clean WHERE age IS NOT NULL GROUP BY age))
UNION ALL
SELECT * FROM (SELECT 'strongest_predictor:' || col, round(a, 6), 'info' FROM ({corr}) WHERE a IS NOT NULL
               ORDER BY a DESC, col LIMIT 1)""")


@register("a21_insights", _a21_sql())
def a21(spark, sf):
    return explore.insights(clean_enc(spark, sf), "target", "age", ["insulin", "metformin"], "specialty", NUM)


# A25
@register("a25_mean_of_group_rates", clean_sql(
    "SELECT insulin, round(avg(rate) * 100, 6) AS mean_rate_pct, count(*) AS groups FROM (SELECT age, insulin, "
    "round(avg(target), 6) AS rate FROM clean WHERE age IS NOT NULL AND insulin IS NOT NULL GROUP BY age, insulin "
    "HAVING count(target) >= 10) WHERE insulin NOT IN ('?') GROUP BY insulin"))
def a25(spark, sf):
    r = explore.rate_by(clean_enc(spark, sf), ["age", "insulin"], min_count=10)
    return explore.mean_of_rates(r, "insulin")


# A26
@register("a26_overall", clean_sql(
    "SELECT round(avg(target), 6) AS rate, CAST(sum(target) AS BIGINT) AS positives, "
    "round(avg(time_in_hospital), 6) AS mean_stay FROM clean"))
def a26(spark, sf):
    return explore.overall(clean_enc(spark, sf), "target", "time_in_hospital")


# Rank positions of |corr with target| (ties by name)
@register("w4_rank_positions", clean_sql(
    "SELECT \"column\", round(abs_corr, 6) AS abs_corr, CAST(row_number() OVER (ORDER BY abs_corr DESC, \"column\") - 1 "
    "AS INTEGER) AS position FROM (" + _union([
        f"SELECT '{c}' AS {C}, abs(corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE))) AS abs_corr FROM clean"
        for c in NUM]) + ")"))
def w4(spark, sf):
    from pyspark.sql import Window
    corr = explore.target_correlations(clean_enc(spark, sf), NUM)
    w = Window.orderBy(F.desc("abs_corr"), F.asc("column"))      # one row per column: a small window
    return corr.select("column", F.round("abs_corr", 6).alias("abs_corr"),
                       (F.row_number().over(w) - 1).cast("int").alias("position"))


# A19 markers: mean and median of the histogrammed column
@register("a19_mean_median", clean_sql(
    "SELECT 'num_med' AS \"column\", round(avg(CAST(num_med AS DOUBLE)), 6) AS mean, "
    "round(quantile_cont(CAST(num_med AS DOUBLE), 0.5), 6) AS median FROM clean"))
def a19m(spark, sf):
    m = explore.mean_median(clean_enc(spark, sf), "num_med")
    return m.select("column", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))
