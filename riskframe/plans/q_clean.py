"""Queries for cleaning, lookups, entity operators and scans (P*, J*, W*, S2, S4) plus the flagship rate."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.codes import categorize_code, categorize_code_sql
from riskframe.operators import clean, explore, lookup
from riskframe.plans.base import (CLEAN_COLUMNS, CODE_LISTS, ENC_COLUMNS, ENC_STRING_COLUMNS, SENTINEL_LABELS,
                                  STAGED_SQL, clean_enc, clean_sql, encounters, q, sql_with, staged)
from riskframe.plans.dims import LOOKUP_SQL, lookup_dim
from riskframe.plans.registry import register


@register("a2_rate_by_disposition_first_visits", clean_sql("""
SELECT disposition_desc, count(target) AS n, round(avg(target), 6) AS rate,
       round(count(target) / (SELECT count(*) FROM clean), 6) AS share
FROM clean GROUP BY disposition_desc"""))
def rate_by_disposition(spark, sf):
    """Minimum slice: clean -> first visit per entity -> lookup -> rate by description."""
    return explore.rate_by(clean_enc(spark, sf), "disposition_desc")


def _staged_sql(body: str, *extra: str) -> str:
    return sql_with(STAGED_SQL, *extra, body=body)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# P1
@register("p1_target_derivation", _staged_sql("SELECT readmitted, target, count(*) AS n FROM staged GROUP BY ALL"))
def p1(spark, sf):
    return staged(spark, sf).groupBy("readmitted", "target").agg(F.count(F.lit(1)).alias("n"))


# P2
def _p2_sql():
    hits = [f"coalesce(disposition_id IN ({', '.join(map(str, v))}), false)" for v in CODE_LISTS.values()]
    per = ", ".join(f"count(*) FILTER (WHERE {h}) AS removed_{r}" for h, r in zip(hits, CODE_LISTS))
    anyh = " OR ".join(hits)
    return sql_with(body=f"SELECT count(*) AS rows_before, {per}, count(*) FILTER (WHERE {anyh}) AS removed_total, "
                         f"count(*) FILTER (WHERE NOT ({anyh})) AS rows_after FROM enc")


@register("p2_exclusion_counts", _p2_sql())
def p2(spark, sf):
    return clean.exclusion_counts(encounters(spark, sf), "disposition_id", CODE_LISTS)


# P3
_P3 = ["weight", "diag_3", "age", "payer_code", "specialty"]


def _p3_sql():
    parts = []
    for c in _P3:
        if c in ENC_COLUMNS:
            sent = f" + count(*) FILTER (WHERE {q(c)} = '?')" if c in ENC_STRING_COLUMNS else ""
            parts.append(f"SELECT '{c}' AS \"column\", true AS present, round((count(*) FILTER (WHERE {q(c)} IS NULL)"
                         f"{sent}) * 100.0 / count(*), 2) AS missing_pct FROM staged")
        else:
            parts.append(f"SELECT '{c}' AS \"column\", false AS present, CAST(NULL AS DOUBLE) AS missing_pct")
    return _staged_sql(_union(parts))


@register("p3_drop_report", _p3_sql())
def p3(spark, sf):
    return clean.drop_report(staged(spark, sf), _P3)


# P4
def _p4_sql():
    parts = [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {q(c)} = '?') AS sentinel_count, "
             f"round(count(*) FILTER (WHERE {q(c)} = '?') * 100.0 / count(*), 2) AS pct FROM staged"
             for c in ENC_STRING_COLUMNS]
    return _staged_sql(_union(parts))


@register("p4_sentinel_counts", _p4_sql())
def p4(spark, sf):
    return clean.sentinel_counts(staged(spark, sf), ENC_STRING_COLUMNS)


def _p4r_sql():
    parts = []
    for c in ["race", "specialty", "diag_1", "diag_2", "diag_3"]:
        lab = SENTINEL_LABELS.get(c, clean.UNKNOWN_LABEL)
        parts.append(f"SELECT '{c}' AS \"column\", CASE WHEN {q(c)} = '?' THEN '{lab}' ELSE {q(c)} END AS value "
                     f"FROM staged")
    return _staged_sql(f"SELECT \"column\", value, count(*) AS n FROM ({_union(parts)}) "
                       f"WHERE value IN ('missing', 'unknown') GROUP BY ALL")


@register("p4_sentinel_replacement", _p4r_sql())
def p4r(spark, sf):
    from riskframe.operators.explore import long_categories
    r = clean.replace_sentinel(staged(spark, sf), SENTINEL_LABELS)
    lv = long_categories(r, ["race", "specialty", "diag_1", "diag_2", "diag_3"])
    return lv.where(F.col("value").isin("missing", "unknown")).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


# P5
def _p5_sql():
    parts = [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {q(c)} IS NULL) AS null_count FROM clean"
             for c in CLEAN_COLUMNS]
    return clean_sql(f"SELECT * FROM ({_union(parts)}) WHERE null_count > 0")


@register("p5_residual_nulls", _p5_sql())
def p5(spark, sf):
    from riskframe.operators.profile import missing_profile
    return missing_profile(clean_enc(spark, sf), None).where(F.col("null_count") > 0).select("column", "null_count")


# P6
@register("p6_derived_means", clean_sql(
    "SELECT round(avg(medication_changed), 6) AS medication_changed, round(avg(total_procedures), 6) AS "
    "total_procedures, round(avg(long_stay), 6) AS long_stay FROM clean"))
def p6(spark, sf):
    c = clean_enc(spark, sf)
    return c.agg(*[F.round(F.avg(k), 6).alias(k) for k in ["medication_changed", "total_procedures", "long_stay"]])


# P7
_P7 = ["num_lab", "num_med"]


@register("p7_negative_medians", _staged_sql(_union([
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < 0) AS negatives, "
    f"quantile_cont({c}, 0.5) FILTER (WHERE {c} >= 0) AS median FROM staged" for c in _P7])))
def p7(spark, sf):
    return clean.negative_medians(staged(spark, sf), _P7)


@register("p7_negative_repair", clean_sql(
    "SELECT count(*) FILTER (WHERE num_lab < 0) AS negatives_left, round(sum(num_lab), 6) AS num_lab_sum, "
    "count(*) AS n FROM clean"))
def p7r(spark, sf):
    c = clean_enc(spark, sf)
    return c.agg(F.count_if(F.col("num_lab") < 0).alias("negatives_left"),
                 F.round(F.sum("num_lab"), 6).alias("num_lab_sum"), F.count(F.lit(1)).alias("n"))


# P8
_P8 = ["num_lab", "num_med", "num_proc"]


@register("p8_rule_counts", _staged_sql(_union(
    [f"SELECT '{c}>30' AS rule, count(*) FILTER (WHERE {c} > 30) AS n FROM staged" for c in _P8] +
    ["SELECT 'time_in_hospital<0' AS rule, count(*) FILTER (WHERE time_in_hospital < 0) AS n FROM staged"])))
def p8(spark, sf):
    return clean.rule_counts(staged(spark, sf), clean.extreme_value_rules(_P8, 30, "time_in_hospital"))


# P9
@register("p9_drop_id_twins", clean_sql("SELECT * EXCLUDE (admission_type_id, disposition_id) FROM clean"))
def p9(spark, sf):
    return clean.drop_ids_with_twin(clean_enc(spark, sf))


# P10
_P10 = [c for c in CLEAN_COLUMNS if c not in ("num_lab", "total_procedures")]


@register("p10_near_unique", clean_sql(_union([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {q(c)}) AS distinct, count(*) AS rows, "
    f"round(count(DISTINCT {q(c)}) / count(*), 6) AS ratio, count(DISTINCT {q(c)}) / count(*) > 0.9 AS near_unique "
    f"FROM clean" for c in _P10])))
def p10(spark, sf):
    return clean.near_unique_columns(clean_enc(spark, sf))


# P10 / P12 decided by sketches: exact counts only where an estimate leaves the question open
@register("p10_near_unique_by_sketch", clean_sql(_union([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {q(c)}) / count(*) > 0.9 AS near_unique FROM clean" for c in CLEAN_COLUMNS])))
def p10s(spark, sf):
    from riskframe.operators.explore import distinct_above
    return distinct_above(clean_enc(spark, sf), CLEAN_COLUMNS, ratio=0.9).select("column", F.col("above").alias("near_unique"))


@register("p12_many_levels_by_sketch", clean_sql(_union([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {q(c)}) > 50 AS many_levels FROM clean" for c in CLEAN_COLUMNS])))
def p12s(spark, sf):
    from riskframe.operators.explore import distinct_above
    return distinct_above(clean_enc(spark, sf), CLEAN_COLUMNS, threshold=50).select("column", F.col("above").alias("many_levels"))


# P11
_P11 = ["encounter_id", "patient_nbr", "readmitted", "diag_1", "diag_2", "diag_3", "weight"]


@register("p11_drop_for_modelling", clean_sql(
    "SELECT * EXCLUDE (encounter_id, patient_nbr, readmitted, diag_1, diag_2, diag_3) FROM clean"))
def p11(spark, sf):
    return clean.drop_columns(clean_enc(spark, sf), _P11)


# P12
_P12_EX = ["encounter_id", "patient_nbr", "target"]


def _p12_sql():
    from riskframe.plans.base import CLEAN_NUMERIC
    parts = []
    for c in CLEAN_COLUMNS:
        if c in _P12_EX:
            continue
        kind = "numeric" if c in CLEAN_NUMERIC else "categorical"
        parts.append(f"SELECT '{c}' AS \"column\", '{kind}' AS kind, count(DISTINCT {q(c)}) AS distinct, "
                     f"{'false' if kind == 'numeric' else f'count(DISTINCT {q(c)}) > 50'} AS high_cardinality FROM clean")
    return clean_sql(_union(parts))


@register("p12_column_partition", _p12_sql())
def p12(spark, sf):
    return clean.column_partition(clean_enc(spark, sf), _P12_EX, 50)


# P13
_TOPN_SQL = """top AS (SELECT specialty AS v FROM clean WHERE specialty IS NOT NULL GROUP BY specialty
                ORDER BY count(*) DESC, specialty LIMIT {n})"""


@register("p13_group_top_n", clean_sql(
    "SELECT coalesce(t.v, 'Others') AS specialty, count(*) AS n FROM clean c LEFT JOIN top t ON c.specialty = t.v "
    "GROUP BY 1", _TOPN_SQL.format(n=5)))
def p13(spark, sf):
    g = clean.group_top_n(clean_enc(spark, sf), "specialty", 5)
    return g.groupBy("specialty").agg(F.count(F.lit(1)).alias("n"))


# P14
@register("p14_filter_top_n", clean_sql(
    "SELECT specialty, count(*) AS n, round(avg(target), 6) AS rate FROM clean WHERE specialty IN (SELECT v FROM top) "
    "GROUP BY specialty", _TOPN_SQL.format(n=6)))
def p14(spark, sf):
    f = clean.filter_top_n(clean_enc(spark, sf), "specialty", 6)
    return f.groupBy("specialty").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("target"), 6).alias("rate"))


# P15
@register("p15_code_categories", _staged_sql(
    f"SELECT {categorize_code_sql('diag_1')} AS diag_group, count(*) AS n FROM staged GROUP BY 1"))
def p15(spark, sf):
    s = staged(spark, sf)
    return s.groupBy(categorize_code(F.col("diag_1")).alias("diag_group")).agg(F.count(F.lit(1)).alias("n"))


# P16
@register("p16_configured_clean", clean_sql(
    "SELECT count(*) AS rows, count(DISTINCT patient_nbr) AS entities, round(avg(target), 6) AS rate, "
    "round(sum(num_lab), 6) AS num_lab_sum FROM clean"))
def p16(spark, sf):
    from riskframe.plans.base import NEGATIVE_COLUMNS
    dim = lookup_dim(spark, sf)
    e = clean.normalize_na(encounters(spark, sf), ENC_STRING_COLUMNS)
    c = clean.clean_pipeline(e, entity="patient_nbr", order="encounter_id", label_source="readmitted",
                             code_column="disposition_id", code_lists=CODE_LISTS, sentinel_labels=SENTINEL_LABELS,
                             negative_columns=NEGATIVE_COLUMNS, derived=clean.standard_derived(),
                             lookups={"admission_type_id": (dim, "admission_type"),
                                      "disposition_id": (dim, "disposition")})
    return c.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("patient_nbr").alias("entities"),
                 F.round(F.avg("target"), 6).alias("rate"), F.round(F.sum("num_lab"), 6).alias("num_lab_sum"))


# W1
@register("w1_prior_count", _staged_sql(
    "SELECT num_previous_admissions, count(*) AS n FROM (SELECT CAST(row_number() OVER (PARTITION BY patient_nbr "
    "ORDER BY encounter_id) - 1 AS BIGINT) AS num_previous_admissions FROM staged) GROUP BY 1"))
def w1(spark, sf):
    p = clean.prior_count(staged(spark, sf), "patient_nbr", "encounter_id")
    return p.groupBy("num_previous_admissions").agg(F.count(F.lit(1)).alias("n"))


# W2
@register("w2_first_per_entity", clean_sql("SELECT patient_nbr, encounter_id, target, num_previous_admissions FROM clean"))
def w2(spark, sf):
    return clean_enc(spark, sf).select("patient_nbr", "encounter_id", "target", "num_previous_admissions")


@register("w2_last_per_entity", _staged_sql(
    "SELECT patient_nbr, encounter_id, readmitted FROM staged QUALIFY row_number() OVER (PARTITION BY patient_nbr "
    "ORDER BY encounter_id DESC) = 1"))
def w2l(spark, sf):
    s = staged(spark, sf).select("patient_nbr", "encounter_id", "readmitted")
    return clean.first_per_entity(s, "patient_nbr", "encounter_id", keep="last")


# W3
@register("w3_full_row_duplicates", _staged_sql(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM staged "
    "GROUP BY ALL_COLUMNS)".replace("ALL_COLUMNS", ", ".join(q(c) for c in ENC_COLUMNS + ["target"]))))
def w3(spark, sf):
    return clean.full_row_duplicates(staged(spark, sf))


# J1
@register("j1_lookup_hits", _staged_sql(
    "SELECT count(*) AS rows, count(d.id) AS mapped, count(*) - count(d.id) AS unmapped FROM staged s "
    "LEFT JOIN (SELECT DISTINCT id FROM lk WHERE mapping = 'disposition') d ON s.disposition_id = d.id", LOOKUP_SQL))
def j1(spark, sf):
    return lookup.lookup_hit_counts(staged(spark, sf), "disposition_id", lookup_dim(spark, sf), "disposition")


@register("j1_lookup_enrichment", clean_sql(
    "SELECT admission_type_desc, disposition_desc, count(*) AS n FROM clean GROUP BY ALL"))
def j1e(spark, sf):
    return clean_enc(spark, sf).groupBy("admission_type_desc", "disposition_desc").agg(F.count(F.lit(1)).alias("n"))


# J1 with a dimension too large to broadcast: hot ids are joined apart
@register("j1_hot_id_enrichment", _staged_sql("""
SELECT coalesce(d.description, 'Unknown') AS disposition_desc, count(*) AS n FROM staged s
LEFT JOIN (SELECT id, min(description) AS description FROM lk WHERE mapping = 'disposition' GROUP BY id) d ON s.disposition_id = d.id GROUP BY 1""", LOOKUP_SQL))
def j1h(spark, sf):
    t = lookup.apply_lookup(staged(spark, sf), "disposition_id", lookup_dim(spark, sf), "disposition", max_rows=0)
    return t.groupBy("disposition_desc").agg(F.count(F.lit(1)).alias("n"))


# J2
@register("j2_coverage", _staged_sql("""
SELECT count(*) AS distinct_ids, count(h) AS matched, count(*) - count(h) AS unmatched,
       round(coalesce(count(h) / nullif(count(*), 0), 0.0), 6) AS coverage
FROM (SELECT DISTINCT disposition_id AS id FROM staged WHERE disposition_id IS NOT NULL) i
LEFT JOIN (SELECT DISTINCT id, 1 AS h FROM lk WHERE mapping = 'disposition') d USING (id)""", LOOKUP_SQL))
def j2(spark, sf):
    return lookup.coverage(staged(spark, sf), "disposition_id", lookup_dim(spark, sf), "disposition")


# J3
@register("j3_unmapped_ids", _staged_sql(
    "SELECT DISTINCT disposition_id AS id FROM staged WHERE disposition_id IS NOT NULL AND disposition_id NOT IN "
    "(SELECT id FROM lk WHERE mapping = 'disposition')", LOOKUP_SQL))
def j3(spark, sf):
    return lookup.unmapped_ids(staged(spark, sf), "disposition_id", lookup_dim(spark, sf), "disposition")


# J4
@register("j4_lookup_summary", sql_with(LOOKUP_SQL, body=
          "SELECT mapping, count(*) AS entries, min(id) AS min_id, max(id) AS max_id, "
          "array_to_string(list(concat_ws('=', CAST(id AS VARCHAR), description) ORDER BY id, description)[1:3], '; ') AS sample FROM lk GROUP BY mapping"))
def j4(spark, sf):
    return lookup.lookup_summary(lookup_dim(spark, sf))


# J5
@register("j5_recombine_label", clean_sql(
    "SELECT x.encounter_id, x.num_med, x.num_proc, y.target FROM (SELECT encounter_id, num_med, num_proc FROM clean) x "
    "JOIN (SELECT encounter_id, target FROM clean) y ON x.encounter_id = y.encounter_id"))
def j5(spark, sf):
    c = clean_enc(spark, sf)
    x = c.select("encounter_id", "num_med", "num_proc")
    y = c.select("encounter_id", "target")
    return x.join(y, "encounter_id")


# J6
@register("j6_unexpected_values", _staged_sql(
    "SELECT DISTINCT gender AS value FROM staged WHERE gender IS NOT NULL AND gender NOT IN ('F', 'O')"))
def j6(spark, sf):
    return lookup.unexpected_values(staged(spark, sf), "gender", ["F", "O"])


@register("j6_intersect_ids", _staged_sql(
    "SELECT disposition_id AS id FROM staged INTERSECT SELECT id FROM lk WHERE mapping = 'disposition'", LOOKUP_SQL))
def j6i(spark, sf):
    ids = staged(spark, sf).select(F.col("disposition_id").alias("id"))
    return ids.intersect(lookup_dim(spark, sf).where(F.col("mapping") == "disposition").select("id"))


# S4
def _s4_sql():
    return ("SELECT 'region' AS mapping, CAST(r_regionkey AS INTEGER) AS id, r_name AS description FROM region "
            "UNION ALL SELECT 'nation', CAST(n_nationkey AS INTEGER), n_name FROM nation "
            "UNION ALL SELECT 'supplier', CAST(s_suppkey AS INTEGER), s_name FROM supplier")


@register("s4_section_reader", _s4_sql())
def s4(spark, sf):
    """Writes region/nation/supplier as one multi-section lookup text, reads it back with the section reader."""
    from riskframe.plans.enc import table
    from riskframe.session import scratch_path
    from riskframe.sources import sections
    secs = [("region", table(spark, sf, "region"), "r_regionkey", "r_name"),
            ("nation", table(spark, sf, "nation"), "n_nationkey", "n_name"),
            ("supplier", table(spark, sf, "supplier"), "s_suppkey", "s_name")]
    body = None
    heads = []
    for i, (name, df, k, d) in enumerate(secs):
        quoted = F.concat(F.lit('"'), F.col(d), F.lit('"'))
        b = df.select(F.lit(i).alias("sec"), F.col(k).cast("long").alias("pos"),
                      F.concat(F.col(k).cast("string"), F.lit(","), quoted).alias("line"))
        body = b if body is None else body.unionByName(b)
        heads.append((i, f"{name}_id,description"))
    hdf = spark.createDataFrame(heads, "sec int, line string")
    path = scratch_path(spark, "sections")
    sections.write_sections(body, hdf, path)
    return sections.read_sections(spark, path)


# The label must be binary (domain check on the cleaned target)
@register("b9_binary_target", clean_sql(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE target IS NULL) AS null_targets, "
    "count(*) FILTER (WHERE target IS NOT NULL AND target NOT IN (0, 1)) AS non_binary FROM clean"))
def b9(spark, sf):
    from riskframe.operators import profile
    c = clean_enc(spark, sf)
    bad = profile.domain_violations(c, {"target": [0, 1]}).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).scalar()
    return c.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("target").isNull()).alias("null_targets")) \
        .withColumn("non_binary", bad)


# A top-k report with an explicit tie-break
@register("w5_top_k", clean_sql(
    "SELECT encounter_id, patient_nbr, num_med FROM clean ORDER BY num_med DESC, encounter_id LIMIT 10"))
def w5(spark, sf):
    return clean_enc(spark, sf).select("encounter_id", "patient_nbr", "num_med") \
        .orderBy(F.desc("num_med"), F.asc("encounter_id")).limit(10)


# Scan the written clean table and check it (not empty, target present, target binary)
@register("s2_clean_scan_checks", clean_sql(
    "SELECT count(*) AS rows, true AS has_target, count(*) FILTER (WHERE target NOT IN (0, 1)) AS non_binary FROM clean"))
def s2(spark, sf):
    c = clean_enc(spark, sf)                     # a parquet scan of the table the cleaning stage wrote
    return c.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(~F.col("target").isin(0, 1)).alias("non_binary")) \
        .withColumn("has_target", F.lit("target" in c.columns))


# P3 threshold mode: columns whose missing share (null or sentinel) exceeds 30%
def _p3t_sql():
    parts = []
    for c in ENC_COLUMNS + ["target"]:
        sent = f" + count(*) FILTER (WHERE {q(c)} = '?')" if c in ENC_STRING_COLUMNS else ""
        parts.append(f"SELECT '{c}' AS \"column\", round((count(*) FILTER (WHERE {q(c)} IS NULL){sent}) * 100.0 / "
                     f"count(*), 2) AS missing_pct FROM staged")
    return _staged_sql(f"SELECT \"column\" FROM ({_union(parts)}) WHERE missing_pct > 30")


@register("p3_threshold_mode", _p3t_sql())
def p3t(spark, sf):
    """The frame behind ``clean.columns_over_missing`` (which collects these names to drop them)."""
    from riskframe.operators.profile import missing_profile
    return missing_profile(staged(spark, sf)).where(F.col("missing_pct") > 30).select("column")
