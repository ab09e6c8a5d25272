"""Queries for scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.plans.base import clean_enc, clean_sql
from riskframe.plans.enc import table
from riskframe.plans.q_features import SPLIT_SQL
from riskframe.plans.registry import register
from riskframe.session import scratch_path
from riskframe.sources import io


# A given table written as CSV (with NA tokens planted in one column), scanned back with inference
@register("s1_csv_scan", """
SELECT count(*) AS rows, count(DISTINCT o_custkey) AS entities, 7 AS columns,
       count(*) FILTER (WHERE o_orderkey % 13 = 0) AS null_priorities FROM orders""")
def s1(spark, sf):
    o = table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 13 == 0, F.lit("NULL")).otherwise(F.col("o_orderpriority"))) \
        .withColumn("o_note", F.when(F.col("o_orderkey") % 2 == 0, F.lit("None")).otherwise(F.lit("x")))
    path = scratch_path(spark, "csv-orders")
    io.write_table(o, path, "csv")
    df, _enc = io.read_csv_any_encoding(spark, path)
    st = io.load_stats(df, "o_custkey")
    nulls = df.agg(F.count_if(F.col("o_orderpriority").isNull())).scalar()
    return st.select("rows", "entities", F.col("columns").cast("int").alias("columns"),
                     nulls.alias("null_priorities"))


# S3
_S3 = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@register("s3_head_sample", f"SELECT {', '.join(_S3)} FROM orders ORDER BY o_orderkey LIMIT 5")
def s3(spark, sf):
    return io.head(table(spark, sf, "orders").select(*_S3), 5, ["o_orderkey"])


# Split table written partitioned by split, read back per split (partition pruning)
@register("s7_split_sink_roundtrip", clean_sql("SELECT split, count(*) AS rows FROM split_t GROUP BY split", SPLIT_SQL))
def s7(spark, sf):
    from riskframe.operators import features as FE
    s = FE.stratified_split(clean_enc(spark, sf), "target", "encounter_id")
    path = scratch_path(spark, "splits")
    io.write_table(s, path, "parquet", partition_by=["split"])
    tr = io.load_split(spark, path, "train").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("train").alias("split"),
                                                                                        "rows")
    te = io.load_split(spark, path, "test").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("test").alias("split"),
                                                                                       "rows")
    return tr.unionByName(te)


# Clean table as CSV, read-back check
@register("s6_clean_csv_readback", clean_sql("SELECT count(*) AS rows_read, count(*) AS rows_written, true AS same_columns "
                                             "FROM clean"))
def s6(spark, sf):
    c = clean_enc(spark, sf)
    path = scratch_path(spark, "clean-csv")
    io.write_table(c, path, "csv")
    return io.read_back_check(spark, c, path, "csv")


# Per-model metric reports as JSON files, read back as one table with the model from the file name
def _s10_sql():
    from riskframe.plans.base import scored_sql

    def one(col):
        cm = (f"count(*) FILTER (WHERE label <> 1 AND {col} < 0.5) AS tn, count(*) FILTER (WHERE label <> 1 AND "
              f"{col} >= 0.5) AS fp, count(*) FILTER (WHERE label = 1 AND {col} < 0.5) AS fn, "
              f"count(*) FILTER (WHERE label = 1 AND {col} >= 0.5) AS tp")
        return (f"SELECT '{col}' AS model, 0.5::DOUBLE AS threshold, tn, fp, fn, tp, "
                f"round(coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + tn + fp + fn, 0), 0.0), 6) AS accuracy, "
                f"round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 6) AS precision, "
                f"round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 6) AS recall, "
                f"round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1, "
                f"round(coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0), 6) AS specificity, "
                f"round(coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0.0), 6) AS npv "
                f"FROM (SELECT {cm} FROM scored)")
    return scored_sql(one("score") + " UNION ALL " + one("score2"))


@register("s10_results_dir", _s10_sql())
def s10(spark, sf):
    from riskframe.operators import metrics as M
    from riskframe.plans.base import scored
    s = scored(spark, sf)
    root = scratch_path(spark, "results")
    for name in ("score", "score2"):
        m = M.classification_metrics(s, "label", name, 0.5)
        m.coalesce(1).write.mode("overwrite").json(f"{root}/{name}_results_run")   # one row per report
    return io.read_results_dir(spark, f"{root}/*_results_run")


# The reports of cleaning, features, metrics and validation, each a written table, read back as one
_REPORTS = {"cleaning": ('SELECT "check" AS item, value', "b18_validate_clean"), "features": ("SELECT metric AS item, value", "f10_processing_report"),
            "metrics": ("UNPIVOT", "m2_classification_metrics"), "validation": ("SELECT metric AS item, mean AS value", "v2_cv_summary_fixed_score")}


def _s8_sql():
    from riskframe.plans import q_features, q_metrics, q_models, q_profile  # noqa: F401  their statements
    from riskframe.plans.registry import ORACLES
    parts = []
    for report, (head, name) in _REPORTS.items():
        if head == "UNPIVOT":
            parts += [f"SELECT '{report}' AS report, '{m}' AS item, {m} AS value FROM ({ORACLES[name]})" for m in _METRICS]
        else:
            parts.append(f"SELECT '{report}' AS report, item, value FROM ({head} FROM ({ORACLES[name]}))")
    return " UNION ALL ".join(parts)


_METRICS = ["accuracy", "precision", "recall", "f1"]


@register("s8_reports", _s8_sql())
def s8(spark, sf):
    from riskframe.plans.registry import QUERIES
    root = scratch_path(spark, "reports")
    cleaning, features, metrics, validation = (QUERIES[name](spark, sf) for _, name in _REPORTS.values())
    one = F.explode(F.array(*[F.struct(F.lit(m).alias("item"), F.col(m).alias("value")) for m in _METRICS])).alias("_s")
    io.write_reports({"cleaning": cleaning.select(F.col("check").alias("item"), "value"), "features": features.select(F.col("metric").alias("item"), "value"),
                      "metrics": metrics.select(one).select("_s.*"),
                      "validation": validation.select(F.col("metric").alias("item"), F.col("mean").alias("value"))}, root)
    return io.read_reports(spark, root).select("report", "item", "value")
