"""Queries for validation and profiling (B1-B21) over the raw encounter view."""

from __future__ import annotations

from riskframe.functions.core import SPECIAL_TOKENS
from riskframe.operators import clean, profile
from riskframe.plans.base import (ENC_COLUMNS, ENC_STRING_COLUMNS, STAGED_SQL, clean_enc, clean_sql, encounters, q, sql_with,
                                  staged)
from riskframe.plans.enc import MED_COLUMNS, table
from riskframe.plans.registry import register

NUMERIC = [c for c in ENC_COLUMNS if c not in ENC_STRING_COLUMNS]
COUNT_COLUMNS = ["time_in_hospital", "num_lab", "num_med", "num_proc"]
ORDERS_REQUIRED = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_comment"]
INT_TYPES = {"admission_type_id", "disposition_id"}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _enc(body: str, *extra: str) -> str:
    return sql_with(*extra, body=body)


# B1
@register("b1_required_columns", "SELECT name AS column, name IN (SELECT column_name FROM information_schema.columns "
          "WHERE table_name = 'orders') AS present FROM (VALUES " +
          ", ".join(f"('{c}')" for c in ORDERS_REQUIRED) + ") t(name)")
def b1(spark, sf):
    return profile.required_columns(table(spark, sf, "orders"), ORDERS_REQUIRED)


# B2
@register("b2_key_uniqueness", _enc("SELECT count(*) AS rows, count(DISTINCT patient_nbr) AS distinct_keys, "
                                    "count(*) - count(DISTINCT patient_nbr) AS duplicate_keys FROM enc"))
def b2(spark, sf):
    return profile.key_uniqueness(encounters(spark, sf), "patient_nbr")


# B3
_DOMAINS = {"gender": ["F", "O"], **{m: ["No", "Steady", "Up", "Down"] for m in MED_COLUMNS},
            "readmitted": ["<30", ">30", "NO"]}


def _b3_sql() -> str:
    parts = []
    for c, vals in _DOMAINS.items():
        lst = ", ".join(f"'{v}'" for v in vals)
        parts.append(f"SELECT '{c}' AS \"column\", CAST({q(c)} AS VARCHAR) AS value FROM enc "
                     f"WHERE {q(c)} IS NOT NULL AND {q(c)} NOT IN ({lst})")
    return _enc(f'SELECT "column", value, count(*) AS n FROM ({_union(parts)}) GROUP BY "column", value')


@register("b3_domain_violations", _b3_sql())
def b3(spark, sf):
    return profile.domain_violations(encounters(spark, sf), _DOMAINS)


# B4
_B4 = ["diag_1", "diag_2", "diag_3", "age"]


@register("b4_non_numeric", _enc(_union([
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE TRY_CAST({q(c)} AS DOUBLE) IS NULL AND {q(c)} IS NOT NULL) "
    f"AS non_numeric FROM enc" for c in _B4])))
def b4(spark, sf):
    return profile.non_numeric_counts(encounters(spark, sf), _B4)


# B5 / B9 / B10 rules
def _rules_sql() -> str:
    return clean_sql("""
SELECT rule, value, passed FROM (
  SELECT count(*) AS rows, count(*) FILTER (WHERE NOT coalesce(target IN (0, 1), false)) AS non_binary,
         avg(target) AS rate, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg,
         count(DISTINCT patient_nbr) AS keys
  FROM clean) a,
LATERAL (VALUES
  ('min_rows', CAST(rows AS DOUBLE), rows >= 100),
  ('binary_target', CAST(non_binary AS DOUBLE), non_binary = 0),
  ('rate_in_range', round(rate, 6), rate >= 0.01 AND rate <= 0.99),
  ('imbalance_ratio', round(CAST(greatest(pos, neg) AS DOUBLE) / nullif(least(pos, neg), 0), 6),
   coalesce(CAST(greatest(pos, neg) AS DOUBLE) / nullif(least(pos, neg), 0) <= 10, false)),
  ('unique_key', CAST(rows - keys AS DOUBLE), rows = keys)
) v(rule, value, passed)""")


@register("b5_table_rules", _rules_sql())
def b5(spark, sf):
    return profile.table_rules(clean_enc(spark, sf), "target", "patient_nbr")


@register("b10_class_balance", clean_sql("""
SELECT target AS class, count(*) AS n, round(count(*) / (SELECT count(*) FROM clean), 6) AS share,
       round((SELECT CAST(max(n) AS DOUBLE) / min(n) FROM (SELECT count(*) AS n FROM clean GROUP BY target)), 6)
         AS imbalance_ratio
FROM clean GROUP BY target"""))
def b10(spark, sf):
    return profile.class_balance(clean_enc(spark, sf), "target")


# B6
def _b6_sql() -> str:
    parts = []
    for c in ENC_COLUMNS:
        is_s = c in ENC_STRING_COLUMNS
        sent = f"count(*) FILTER (WHERE {q(c)} = '?')" if is_s else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{c}' AS \"column\", '{'string' if is_s else 'numeric'}' AS dtype, "
                     f"count(*) FILTER (WHERE {q(c)} IS NULL) AS null_count, {sent} AS sentinel_count, "
                     f"count(*) AS total, round((count(*) FILTER (WHERE {q(c)} IS NULL) + {sent}) * 100.0 / count(*), 2)"
                     f" AS missing_pct FROM enc")
    return _union(parts)


B6_SQL_BODY = _b6_sql()


@register("b6_missing_profile", _enc(B6_SQL_BODY))
def b6(spark, sf):
    return profile.missing_profile(encounters(spark, sf))


@register("b7_missing_ranking", _enc(f"""
SELECT "column", missing_pct, CAST(row_number() OVER (ORDER BY missing_pct DESC, "column") AS INTEGER) AS rank
FROM ({B6_SQL_BODY}) WHERE missing_pct > 0"""))
def b7(spark, sf):
    return profile.missing_ranking(encounters(spark, sf))


def _b7_totals_sql() -> str:
    n = len(ENC_COLUMNS)
    nulls = " + ".join(f"count(*) FILTER (WHERE {q(c)} IS NULL)" for c in ENC_COLUMNS)
    zero_cols = " + ".join(f"CAST(count(*) FILTER (WHERE {q(c)} IS NULL) = 0 AS INTEGER)" for c in ENC_COLUMNS)
    complete = " AND ".join(f"{q(c)} IS NOT NULL" for c in ENC_COLUMNS)
    return _enc(f"""SELECT count(*) * {n} AS cells, CAST({nulls} AS BIGINT) AS null_cells,
  round(({nulls}) * 100.0 / (count(*) * {n}), 2) AS null_pct,
  count(*) FILTER (WHERE {complete}) AS complete_rows, CAST({zero_cols} AS BIGINT) AS columns_without_nulls FROM enc""")


@register("b7_missing_totals", _b7_totals_sql())
def b7t(spark, sf):
    return profile.missing_totals(encounters(spark, sf))


# B8
def _b8_sql() -> str:
    parts = []
    for c in ENC_STRING_COLUMNS:
        for t in SPECIAL_TOKENS:
            parts.append(f"SELECT '{c}' AS \"column\", '{t}' AS token, count(*) FILTER (WHERE {q(c)} = '{t}') AS n, "
                         f"count(*) AS _n FROM enc")
    return _enc(f'SELECT "column", token, n, round(n * 100.0 / _n, 2) AS pct FROM ({_union(parts)}) WHERE n > 0')


@register("b8_special_tokens", _b8_sql())
def b8(spark, sf):
    return profile.special_token_census(encounters(spark, sf))


# B11
_B11 = ["age", "time_in_hospital", "diag_2", "diag_3", "race"]


@register("b11_missing_patterns", sql_with(STAGED_SQL, body=f"""
SELECT {', '.join(f'CAST({q(c)} IS NULL AS INTEGER) AS {q("null_" + c)}' for c in _B11)}, count(*) AS n
FROM staged GROUP BY ALL ORDER BY n DESC, {', '.join(q('null_' + c) for c in _B11)} LIMIT 10"""))
def b11(spark, sf):
    return profile.missing_patterns(staged(spark, sf), _B11)


# B12
@register("b12_nulls_per_row", sql_with(STAGED_SQL, body=f"""
SELECT {' + '.join(f'CAST({q(c)} IS NULL AS INTEGER)' for c in ENC_COLUMNS + ['target'])} AS nulls_in_row,
       count(*) AS rows, sum(nulls_in_row * count(*)) OVER () / sum(count(*)) OVER () AS mean FROM staged GROUP BY 1"""))
def b12(spark, sf):
    return profile.nulls_per_row(staged(spark, sf))


# B13
@register("b13_value_distribution", sql_with(STAGED_SQL, body="""
SELECT age AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM staged), 4) AS pct
FROM staged GROUP BY age"""))
def b13(spark, sf):
    return profile.value_distribution(staged(spark, sf), "age", dropna=False)


# B14
def _b14_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", CAST({q(c)} AS DOUBLE) AS v FROM enc" for c in COUNT_COLUMNS]
    return _enc(f"""
SELECT "column", q1, q3, iqr, lower, upper, outliers, round(outliers * 100.0 / rws, 2) AS outlier_pct FROM (
  SELECT l."column" AS "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
         count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS rws
  FROM ({_union(parts)}) l
  JOIN (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM ({_union(parts)})
        GROUP BY "column") qq ON l."column" = qq."column"
  GROUP BY l."column", q1, q3)""")


@register("b14_iqr_outliers", _b14_sql())
def b14(spark, sf):
    return profile.iqr_outliers(encounters(spark, sf), COUNT_COLUMNS)


# B15
@register("b15_quality_score", _enc(f"""
SELECT round(m, 6) AS mean_missing_pct, round(d, 6) AS duplicate_pct, round(greatest(0.0, 100 - m - d), 6) AS quality_score
FROM (SELECT avg(missing_pct) AS m FROM ({B6_SQL_BODY})),
     (SELECT (count(*) - count(DISTINCT encounter_id)) * 100.0 / count(*) AS d FROM enc)"""))
def b15(spark, sf):
    return profile.quality_score(encounters(spark, sf), "encounter_id")


# B16
@register("b16_entity_multiplicity", _enc("""
SELECT count(*) AS entities, count(*) FILTER (WHERE n > 1) AS multi_entities,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows
FROM (SELECT patient_nbr, count(*) AS n FROM enc GROUP BY patient_nbr)"""))
def b16(spark, sf):
    return clean.entity_dedupe_counts(encounters(spark, sf), "patient_nbr")


# B17
@register("b17_basic_info", _enc(f"SELECT count(*) AS rows, count(DISTINCT patient_nbr) AS entities, "
                                  f"{len(ENC_COLUMNS)} AS columns FROM enc"))
def b17(spark, sf):
    return profile.basic_info(encounters(spark, sf), "patient_nbr")


# The schema with what the columns hold, and the first rows
_TYPES = {c: "bigint" for c in ("encounter_id", "patient_nbr", "time_in_hospital", "num_lab", "num_med", "num_proc")} | \
    {c: "int" for c in ("admission_type_id", "disposition_id")}


@register("b17_column_types", _enc(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {i + 1} AS position, '{_TYPES.get(c, 'string')}' AS type, count({q(c)}) AS non_null, "
    f"min(CAST({q(c)} AS VARCHAR)) AS smallest FROM enc" for i, c in enumerate(ENC_COLUMNS))))
def b17t(spark, sf):
    return profile.column_types(encounters(spark, sf))


@register("b17_head_rows", _enc(" UNION ALL ".join(
    f"SELECT CAST(r AS INTEGER) AS \"row\", '{c}' AS \"column\", CAST({q(c)} AS VARCHAR) AS value FROM first" for c in ENC_COLUMNS),
    "\nfirst AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY encounter_id) AS r FROM enc) WHERE r <= 5)"))
def b17h(spark, sf):
    return profile.head_rows(encounters(spark, sf), ["encounter_id"], 5)


# B18
def _b18_sql() -> str:
    from riskframe.plans.base import CLEAN_COLUMNS
    cols = CLEAN_COLUMNS
    nulls = " + ".join(f"CAST({q(c)} IS NULL AS BIGINT)" for c in cols)
    return clean_sql(f"""
SELECT check_name AS "check", value, issue FROM (
  SELECT count(*) AS rows, avg(target) AS rate, sum({nulls}) AS nulls, count(DISTINCT patient_nbr) AS entities,
         (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM clean GROUP BY {', '.join(q(c) for c in cols)})) AS dups
  FROM clean) a,
LATERAL (VALUES
  ('rows', CAST(rows AS DOUBLE), rows = 0),
  ('target_rate', round(rate, 6), rate < 0.01 OR rate > 0.99),
  ('missing_pct', round(coalesce(nulls * 100.0 / (rows * {len(cols)}), 0.0), 6),
   coalesce(nulls * 100.0 / (rows * {len(cols)}), 0.0) > 10),
  ('duplicate_rows', CAST(dups AS DOUBLE), dups > 0),
  ('entities', CAST(entities AS DOUBLE), false)
) v(check_name, value, issue)""")


@register("b18_validate_clean", _b18_sql())
def b18(spark, sf):
    return profile.validate_table(clean_enc(spark, sf), "target", "patient_nbr")


# B19
def _b19_sql() -> str:
    from riskframe.plans.base import CLEAN_COLUMNS
    def one(tbl, cols, has_target):
        filled = " + ".join(f"CAST({q(c)} IS NOT NULL AS BIGINT)" for c in cols)
        rate = "avg(target)" if has_target else "CAST(NULL AS DOUBLE)"
        return (f"SELECT CAST(count(*) AS DOUBLE) AS rows, CAST({len(cols)} AS DOUBLE) AS columns, "
                f"CAST(count(DISTINCT patient_nbr) AS DOUBLE) AS entities, "
                f"round(sum({filled}) * 100.0 / (count(*) * {len(cols)}), 6) AS completeness, round({rate}, 6) AS rate "
                f"FROM {tbl}")
    return clean_sql(f"""
SELECT metric, b AS before, a AS after FROM (
  SELECT * FROM ({one('enc', ENC_COLUMNS, False)}) b0, ({one('clean', CLEAN_COLUMNS, True)}) a0,
  LATERAL (VALUES ('rows', b0.rows, a0.rows), ('columns', b0.columns, a0.columns),
                  ('entities', b0.entities, a0.entities), ('completeness', b0.completeness, a0.completeness),
                  ('rate', b0.rate, a0.rate), ('retention_pct', 100.0, round(a0.rows * 100.0 / b0.rows, 6))) v(metric, b, a))""")


@register("b19_before_after", _b19_sql())
def b19(spark, sf):
    return profile.before_after(encounters(spark, sf), clean_enc(spark, sf), "patient_nbr", "target")


# B20
def _b20_sql() -> str:
    from riskframe.plans.base import CLEAN_COLUMNS, CLEAN_NUMERIC
    parts = []
    for c in CLEAN_COLUMNS:
        if c in CLEAN_NUMERIC:
            kind = (f"CASE WHEN count(DISTINCT {q(c)}) = 2 AND count(*) FILTER (WHERE {q(c)} NOT IN (0, 1)) = 0 THEN 'binary' "
                    f"WHEN count(DISTINCT {q(c)}) < 10 THEN 'categorical' ELSE 'numeric' END")
        else:
            kind = "'categorical'"
        parts.append(f"SELECT '{c}' AS \"column\", {kind} AS kind, count(*) FILTER (WHERE {q(c)} IS NULL) AS nulls, "
                     f"count(DISTINCT {q(c)}) AS distinct FROM clean")
    return clean_sql(_union(parts))


@register("b20_feature_summary", _b20_sql())
def b20(spark, sf):
    return profile.feature_summary(clean_enc(spark, sf))


# B21
def _b21_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", count({q(c)}) AS count, avg({q(c)}) AS mean, stddev_samp({q(c)}) AS std, "
             f"CAST(min({q(c)}) AS DOUBLE) AS min, quantile_cont({q(c)}, 0.25) AS q25, quantile_cont({q(c)}, 0.5) AS q50, "
             f"quantile_cont({q(c)}, 0.75) AS q75, CAST(max({q(c)}) AS DOUBLE) AS max FROM clean" for c in COUNT_COLUMNS]
    return clean_sql(_union(parts))


@register("b21_describe", _b21_sql())
def b21(spark, sf):
    return profile.describe(clean_enc(spark, sf), COUNT_COLUMNS)
