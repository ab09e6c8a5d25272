"""Lookup enrichment and coverage.

A lookup is a long dimension ``(mapping, id, description)`` holding several
small id -> text dictionaries. Dimensions are broadcast only after their size
is checked (:func:`bounded_broadcast`); past the bound the join stays a
shuffle join, which AQE may still convert from runtime statistics.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.core import qcol

# --- fixed values --------------------------------------------------------------
UNKNOWN = "Unknown"
BROADCAST_MAX_ROWS = 1_000_000
HOT_IDS, HOT_ITEMS_TRACKED = 64, 4_096     # ids that a join treats apart at most, and counters of the sketch that finds them
# --------------------------------------------------------------------------------


def bounded_broadcast(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``dim`` only if it has at most ``max_rows`` rows now (a bounded count job, never remembered)."""
    return F.broadcast(dim) if dim.limit(max_rows + 1).count() <= max_rows else dim


def hot_ids(df: DataFrame, column: str, share: float | None = None) -> list:
    """Ids that hold more than ``share`` of the rows (default: what an average shuffle partition holds), by mergeable
    frequent-item counters in one aggregate; HOT_IDS at most. An estimate may add or miss an id near the bound, which
    changes how a join runs, not what it gives."""
    share = share or 1.0 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = df.agg(F.expr(f"approx_top_k(`{column}`, {HOT_IDS}, {HOT_ITEMS_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in row["top"] or [] if x["item"] is not None and x["count"] > share * row["n"]]


def left_join_by_id(df: DataFrame, column: str, dim: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """``df`` left join ``dim`` (one row an id ``key``) where ``dim`` is too large to broadcast: rows of hot ids meet the few
    dimension rows of these ids where they are, only the others are shuffled by id."""
    hot = hot_ids(df, column, share)
    if not hot:
        return df.join(dim, qcol(column) == F.col(key), "left")
    mine = F.coalesce(qcol(column).isin(hot), F.lit(False))
    apart = df.where(mine).join(F.broadcast(dim.where(F.col(key).isin(hot))), qcol(column) == F.col(key), "left")      # HOT_IDS rows
    return apart.unionByName(df.where(~mine).join(dim, qcol(column) == F.col(key), "left"))


def apply_lookup(df: DataFrame, column: str, dim: DataFrame, mapping: str | None = None, name: str | None = None,
                 default: str = UNKNOWN, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Left equi-join ``column`` -> description; no match or null description -> ``default``.

    Of several descriptions of an id the smallest counts. The size check runs on the mapping's own rows; beyond it hot ids
    are joined apart."""
    d = dim.where(F.col("mapping") == mapping) if mapping is not None else dim
    d = d.groupBy(F.col("id").alias("_lk_id")).agg(F.min("description").alias("_lk_desc"))
    out_name = name or (column[:-3] if column.endswith("_id") else column) + "_desc"
    if d.limit(max_rows + 1).count() <= max_rows:
        j = df.join(F.broadcast(d), qcol(column) == F.col("_lk_id"), "left")
    else:
        j = left_join_by_id(df, column, d, "_lk_id")
    return j.withColumn(out_name, F.coalesce(F.col("_lk_desc"), F.lit(default))).drop("_lk_id", "_lk_desc")


def apply_lookups(df: DataFrame, lookups: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``{column: (dim, mapping)}``; columns absent from ``df`` are skipped."""
    out = df
    for col, (dim, mapping) in lookups.items():
        if col in df.columns:
            out = apply_lookup(out, col, dim, mapping)
    return out


def lookup_hit_counts(df: DataFrame, column: str, dim: DataFrame, mapping: str | None = None) -> DataFrame:
    """One row: rows, mapped rows (id present in the dimension, whatever its description), unmapped rows. Rows are counted
    by id first, so an id is joined once however many rows hold it."""
    d = dim.where(F.col("mapping") == mapping) if mapping is not None else dim
    d = d.select(F.col("id").alias("_id")).distinct()
    held = df.groupBy(qcol(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    j = held.join(bounded_broadcast(d), F.col("_v") == F.col("_id"), "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return j.agg(total("_n").alias("rows"), total(F.when(F.col("_id").isNotNull(), F.col("_n"))).alias("mapped"),
                 total(F.when(F.col("_id").isNull(), F.col("_n"))).alias("unmapped"))


def unmapped_ids(df: DataFrame, column: str, dim: DataFrame, mapping: str | None = None) -> DataFrame:
    """Distinct non-null ids with no dimension row (left anti join)."""
    d = dim.where(F.col("mapping") == mapping) if mapping is not None else dim
    ids = df.select(qcol(column).alias("id")).where(F.col("id").isNotNull()).distinct()
    return ids.join(d.select("id"), "id", "left_anti")


def coverage(df: DataFrame, column: str, dim: DataFrame, mapping: str | None = None) -> DataFrame:
    """One row: distinct ids, matched, unmatched, coverage rate (0 when no ids)."""
    d = dim.where(F.col("mapping") == mapping) if mapping is not None else dim
    ids = df.select(qcol(column).alias("id")).where(F.col("id").isNotNull()).distinct()
    flagged = ids.join(d.select("id").distinct().withColumn("_hit", F.lit(1)), "id", "left")
    return flagged.agg(F.count(F.lit(1)).alias("distinct_ids"),
                       F.count_if(F.col("_hit").isNotNull()).alias("matched"),
                       F.count_if(F.col("_hit").isNull()).alias("unmatched")) \
        .withColumn("coverage", F.round(F.coalesce(F.try_divide(F.col("matched").cast("double"),
                                                                  F.col("distinct_ids")), F.lit(0.0)), 6))


def lookup_summary(dim: DataFrame, sample: int = 3) -> DataFrame:
    """Per mapping: entries, min id, max id, and its first ``sample`` entries by id as text."""
    first = dim.withColumn("_r", F.row_number().over(Window.partitionBy("mapping").orderBy("id", "description"))) \
        .where(F.col("_r") <= sample).groupBy("mapping").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
            "_r", F.concat_ws("=", F.col("id").cast("string"), "description").alias("e")))), lambda x: x["e"]), "; ").alias("sample"))
    return dim.groupBy("mapping").agg(F.count(F.lit(1)).alias("entries"), F.min("id").alias("min_id"),
                                      F.max("id").alias("max_id")).join(first, "mapping")


def unexpected_values(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Distinct values outside ``allowed`` (set difference against an inline domain)."""
    dom = df.sparkSession.createDataFrame([(v,) for v in allowed], f"value {df.schema[column].dataType.simpleString()}")
    vals = df.select(qcol(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    return vals.join(F.broadcast(dom), "value", "left_anti")
