"""Queries for feature preparation (F*) and fold assignment (V1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from riskframe.functions.core import hash_order_sql
from riskframe.operators import features as FE
from riskframe.plans.base import clean_enc, clean_sql, q
from riskframe.plans.registry import register

SCALE = ["time_in_hospital", "num_lab", "num_med", "num_proc", "total_procedures"]
ONEHOT = ["race", "gender", "age"]
H = hash_order_sql(42, "encounter_id")


def split_frame(spark, sf):
    return FE.stratified_split(clean_enc(spark, sf), "target", "encounter_id")


SPLIT_SQL = f"""split_t AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY target ORDER BY {H}, encounter_id) - 1 < ceil(n_c * 0.2)
                 THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, count(*) OVER (PARTITION BY target) AS n_c FROM clean))"""


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# F1
@register("f1_one_hot_counts", clean_sql(_union([
    f"SELECT '{c}_' || {q(c)} AS feature, CAST(count(*) AS BIGINT) AS ones FROM clean WHERE {q(c)} IS NOT NULL AND "
    f"{q(c)} > (SELECT min({q(c)}) FROM clean) GROUP BY {q(c)}" for c in ONEHOT])))
def f1(spark, sf):
    enc = FE.one_hot(clean_enc(spark, sf), ONEHOT)
    return FE.dummy_counts(enc, ONEHOT)


@register("f1_one_hot_rows", clean_sql(
    "SELECT encounter_id, " + ", ".join(
        f"CAST(coalesce(gender = '{v}', false) AS INTEGER) AS \"gender_{v}\"" for v in ["O", "P"]) + " FROM clean"))
def f1r(spark, sf):
    return FE.one_hot(clean_enc(spark, sf).select("encounter_id", "gender"), ["gender"])


# F3
@register("f3_stratified_split", clean_sql("SELECT encounter_id, target, split FROM split_t", SPLIT_SQL))
def f3(spark, sf):
    return split_frame(spark, sf).select("encounter_id", "target", "split")


@register("f3_split_balance", clean_sql(
    "SELECT split, count(*) AS n, round(avg(target), 6) AS rate, round((SELECT max(r) - min(r) FROM (SELECT avg(target) "
    "AS r FROM split_t GROUP BY split)), 6) AS max_gap FROM split_t GROUP BY split", SPLIT_SQL))
def f3b(spark, sf):
    return FE.split_balance(split_frame(spark, sf), "target")


@register("j7_split_disjoint", clean_sql(
    "SELECT (SELECT count(*) FROM (SELECT encounter_id FROM split_t WHERE split = 'train' INTERSECT "
    "SELECT encounter_id FROM split_t WHERE split = 'test')) AS overlap, count(*) AS rows FROM split_t", SPLIT_SQL))
def j7(spark, sf):
    s = split_frame(spark, sf)
    tr = s.where("split = 'train'").select("encounter_id")
    te = s.where("split = 'test'").select("encounter_id")
    overlap = tr.intersect(te).agg(F.count(F.lit(1))).scalar()
    return tr.unionByName(te).agg(F.count(F.lit(1)).alias("rows")).select(overlap.alias("overlap"), "rows")


# V1
@register("v1_stratified_folds", clean_sql(
    f"SELECT encounter_id, target, CAST((row_number() OVER (PARTITION BY target ORDER BY {H}, encounter_id) - 1) % 5 "
    f"AS INTEGER) AS fold FROM clean"))
def v1(spark, sf):
    return FE.stratified_folds(clean_enc(spark, sf), "target", "encounter_id", 5).select("encounter_id", "target", "fold")


# F4 / F5
def _scaled_sql():
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train') AS m_{c}, "
                      f"coalesce(nullif(stddev_pop(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train'), 0), 1.0) AS s_{c}"
                      for c in SCALE)
    cols = ", ".join(f"(CAST({c} AS DOUBLE) - m_{c}) / s_{c} AS {c}" for c in SCALE)
    return f"""st AS (SELECT {stats} FROM split_t),
scaled AS (SELECT encounter_id, target, split, {cols} FROM split_t, st)"""


@register("f4_standard_scaling", clean_sql(
    "SELECT encounter_id, split, " + ", ".join(f"round({c}, 6) AS {c}" for c in SCALE) + " FROM scaled",
    SPLIT_SQL, _scaled_sql()))
def f4(spark, sf):
    s = split_frame(spark, sf)
    cols = FE.scalable_columns(s, SCALE)
    out = FE.standard_scale(s, cols)
    return out.select("encounter_id", "split", *[F.round(c, 6).alias(c) for c in SCALE])


@register("f5_scaling_drift", clean_sql(_union([
    f"SELECT '{c}' AS \"column\", round(avg({c}) FILTER (WHERE split = 'train'), 6) AS train_mean, "
    f"round(avg({c}) FILTER (WHERE split = 'test'), 6) AS test_mean, "
    f"round(stddev_pop({c}) FILTER (WHERE split = 'train'), 6) AS train_std, "
    f"round(stddev_pop({c}) FILTER (WHERE split = 'test'), 6) AS test_std, "
    f"round(abs(avg({c}) FILTER (WHERE split = 'train') - avg({c}) FILTER (WHERE split = 'test')), 6) AS mean_gap, "
    f"abs(avg({c}) FILTER (WHERE split = 'train') - avg({c}) FILTER (WHERE split = 'test')) > 0.5 AS warn FROM scaled"
    for c in SCALE]), SPLIT_SQL, _scaled_sql()))
def f5(spark, sf):
    out = FE.standard_scale(split_frame(spark, sf), SCALE)
    d = FE.scaling_drift(out, SCALE)
    return d.select("column", *[F.round(c, 6).alias(c) for c in
                                ["train_mean", "test_mean", "train_std", "test_std", "mean_gap"]], "warn")


# F8
@register("f8_balanced_weights", clean_sql(
    "SELECT target, round((SELECT count(*) FROM clean) / (2.0 * count(*)), 6) AS weight, count(*) AS n FROM clean "
    "GROUP BY target"))
def f8(spark, sf):
    w = FE.balanced_weights(clean_enc(spark, sf), "target")
    return w.groupBy("target").agg(F.round(F.first("weight"), 6).alias("weight"), F.count(F.lit(1)).alias("n"))


# F6 (vector path; rows-only)
_F6_CAT, _F6_NUM = ONEHOT + ["specialty"], ["num_lab", "num_med", "num_proc"]


def _f6_sql():
    z = " + ".join(f"coalesce((CAST({q(c)} AS DOUBLE) - s.m_{c}) / coalesce(nullif(s.s_{c}, 0), 1), 0)" for c in _F6_NUM)
    seen = " + ".join(f"CAST(coalesce(list_contains(s.v_{c}[2:], {q(c)}), false) AS INTEGER)" for c in _F6_CAT)
    slots = " + ".join(f"len(s.v_{c}) - 1" for c in _F6_CAT)
    stats = ", ".join([f"avg(CAST({q(c)} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({q(c)} AS DOUBLE)) AS s_{c}" for c in _F6_NUM]
                      + [f"list_sort(list(DISTINCT {q(c)}) FILTER ({q(c)} IS NOT NULL)) AS v_{c}" for c in _F6_CAT])
    return clean_sql(f"SELECT encounter_id, split, CAST({len(_F6_NUM)} + {slots} AS INTEGER) AS n_features, {z} + {seen} AS feature_sum "
                     "FROM split_t, s", SPLIT_SQL + f", s AS (SELECT {stats} FROM split_t WHERE split = 'train')")


@register("f6_vector_pipeline", _f6_sql())
def f6(spark, sf):
    from pyspark.ml.functions import vector_to_array
    s = split_frame(spark, sf)
    pipe = FE.vector_pipeline(_F6_CAT, _F6_NUM)
    model = pipe.fit(s.where("split = 'train'"))
    t = model.transform(s)
    arr = vector_to_array("features")
    return t.select("encounter_id", "split", F.size(arr).alias("n_features"),
                    F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"))


# processing report (columns before/after one-hot, encoded sources, rows)
def _f10_sql():
    from riskframe.plans.base import CLEAN_COLUMNS
    n = len(CLEAN_COLUMNS)
    dummies = " + ".join(f"(count(DISTINCT {q(c)}) - 1)" for c in ONEHOT)
    return clean_sql(f"""
SELECT metric, value FROM (SELECT count(*) AS r, {dummies} AS d FROM clean),
LATERAL (VALUES ('columns_before', {float(n)}), ('columns_after', CAST({n} - {len(ONEHOT)} + d AS DOUBLE)),
                ('encoded_columns', {float(len(ONEHOT))}), ('high_cardinality_columns', 0.0),
                ('rows', CAST(r AS DOUBLE))) v(metric, value)""")


@register("f10_processing_report", _f10_sql())
def f10(spark, sf):
    c = clean_enc(spark, sf)
    enc = FE.one_hot(c, ONEHOT)
    from riskframe.operators.clean import column_partition
    return FE.processing_report(c, enc, column_partition(c.select(*ONEHOT)))


# feature / target separation with checks (assembled vector + rule counts)
@register("f2_feature_target_separation", clean_sql(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE target IS NULL) AS null_targets, "
    "count(*) FILTER (WHERE NOT coalesce(target IN (0, 1), false)) AS non_binary, avg(target) AS positive_rate, "
    f"{len(SCALE) + 2} AS n_features FROM clean"))
def f2(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    c = clean_enc(spark, sf)
    feats = [x for x in SCALE + ["long_stay", "medication_changed"]]
    v = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep").transform(c)
    return v.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("target").isNull()).alias("null_targets"),
                 F.count_if(~F.coalesce(F.col("target").isin(0, 1), F.lit(False))).alias("non_binary"),
                 F.avg("target").alias("positive_rate"), F.max(F.size(vector_to_array("features"))).alias("n_features"))


# synthetic minority rows among the training rows (their number, and none outside the minority's range)
@register("f9_oversample", clean_sql(f"""
SELECT target, false AS synthetic, n, 0 AS outside FROM c
UNION ALL SELECT (SELECT target FROM c ORDER BY n, target LIMIT 1), true, (SELECT max(n) - min(n) FROM c), 0""",
    SPLIT_SQL + ", c AS (SELECT target, count(*) AS n FROM split_t WHERE split = 'train' GROUP BY target)"))
def f9(spark, sf):
    cols = ["num_lab", "num_med", "num_proc"]
    s = split_frame(spark, sf).where("split = 'train'")
    out = FE.oversample(s, cols, "target", "encounter_id")
    real = out.where("NOT synthetic").groupBy("target").agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    j = out.join(F.broadcast(real), "target")            # one row a class
    outside = reduce(lambda a, b: a | b, [~F.col(c).between(F.col(f"lo_{c}") - 1e-9, F.col(f"hi_{c}") + 1e-9) for c in cols])
    return j.groupBy("target", "synthetic").agg(F.count("*").alias("n"), F.count_if(outside).cast("int").alias("outside"))
