"""Base encounter view ``enc`` re-aimed onto the driver's order tables.

One row per order: the customer plays the entity (patient), the order the
encounter. Categories carry sentinel/NA tokens and a few numerics are negated
or nulled, deterministically by order key, so cleaning operators have work to
do. ``ENC_SQL`` is the same view as a DuckDB CTE for the oracle queries; the
two definitions must stay in lock-step.

Label: days from an order to the customer's next order (<=30 -> '<30',
>30 -> '>30', none -> 'NO').
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.lookup import hot_ids
from riskframe.operators.ordered import next_within

# --- fixed values --------------------------------------------------------------
MED_COLUMNS = ["metformin", "insulin", "glyburide-metformin"]
DIAG_COLUMNS = ["diag_1", "diag_2", "diag_3"]
LINES_AT_ONCE = 250_000       # lines that a task aggregates
# --------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _diag(k):
    return (F.when(k.isNull(), F.lit(None).cast("string"))
            .when(k % 19 == 0, F.concat(F.lit("V"), (k % 90).cast("string")))
            .when(k % 29 == 0, F.concat(F.lit("E"), (k % 900).cast("string")))
            .when(k % 31 == 0, F.lit("?"))
            .otherwise(F.concat((k % 1000).cast("string"), F.lit("."), (k % 10).cast("string"))))


def _diag_sql(k: str) -> str:
    return (f"CASE WHEN {k} IS NULL THEN NULL WHEN {k} % 19 = 0 THEN 'V' || CAST({k} % 90 AS VARCHAR) "
            f"WHEN {k} % 29 = 0 THEN 'E' || CAST({k} % 900 AS VARCHAR) WHEN {k} % 31 = 0 THEN '?' "
            f"ELSE CAST({k} % 1000 AS VARCHAR) || '.' || CAST({k} % 10 AS VARCHAR) END")


def line_totals(lineitem: DataFrame) -> DataFrame:
    """One row per order key. Lines move once, by order, in parts of about LINES_AT_ONCE rows: lines -> (order, supplier) ->
    order are aggregates of that one layout. Lines of a hot order are dealt by (order, supplier) instead, and a hot order
    never has to hold its supplier set in one task (a per-order collect_set would). Lines without an order meet no order."""
    src = lineitem.where(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_quantity", (F.col("l_returnflag") == "R").alias("ret"))
    parts = max(lineitem.sparkSession.sparkContext.defaultParallelism, math.ceil(lineitem.count() / LINES_AT_ONCE))

    def totals(lines):
        return lines.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"), F.count_if("ret").alias("n_ret"),
            F.count_distinct("l_suppkey").alias("n_supp"), F.min("l_partkey").alias("min_part"), F.min("l_suppkey").alias("min_supp"))
    hot = hot_ids(src, "l_orderkey", 1.0 / parts)
    if not hot:
        return totals(src.repartition(parts, "l_orderkey"))
    mine = F.col("l_orderkey").isin(hot)
    return totals(src.where(~mine).repartition(parts, "l_orderkey")).unionByName(totals(src.where(mine)))


def enc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                                  "o_orderpriority", "o_totalprice")
    # the label needs only the order table: next order date per customer (skew-safe lead)
    orders = next_within(orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate", "next_date")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    li = line_totals(table(spark, sf_dir, "lineitem"))
    # nation (25 rows) is a fixed-size dimension; customer and lineitem grow with
    # the data and are left to the planner (AQE picks broadcast only from runtime size).
    base = (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    k = F.col("o_orderkey")
    n_lines = F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint")
    n_ret = F.coalesce(F.col("n_ret"), F.lit(0)).cast("bigint")
    gap = F.datediff(F.col("next_date").cast("date"), F.col("o_orderdate").cast("date"))
    met = (F.when(n_lines % 4 == 0, "No").when(n_lines % 4 == 1, "Steady").when(n_lines % 4 == 2, "Up")
           .otherwise("Down"))
    ins = F.when(k % 5 <= 1, "No").when(k % 5 == 2, "Steady").when(k % 5 == 3, "Up").otherwise("Down")
    gm = F.when(n_ret == 0, "No").when(n_ret % 2 == 1, "Steady").otherwise("Up")
    out = base.select(
        k.alias("encounter_id"),
        F.col("o_custkey").alias("patient_nbr"),
        F.when(k % 17 == 0, "?").otherwise(F.col("c_mktsegment")).alias("race"),
        F.col("o_orderstatus").alias("gender"),
        F.when(k % 41 == 0, "None").otherwise(F.col("o_orderpriority")).alias("age"),
        (F.col("n_regionkey") + 1).cast("int").alias("admission_type_id"),
        (k % 30).cast("int").alias("disposition_id"),
        F.when(k % 2 == 0, "?").otherwise(F.col("n_name")).alias("specialty"),
        F.when(k % 23 == 0, F.lit(None)).otherwise(F.coalesce(F.col("n_supp"), F.lit(0))).cast("bigint")
        .alias("time_in_hospital"),
        F.when(k % 101 == 0, -n_lines).otherwise(n_lines).alias("num_lab"),
        F.coalesce(F.col("qty"), F.lit(0)).cast("bigint").alias("num_med"),
        n_ret.alias("num_proc"),
        _diag(k).alias("diag_1"), _diag(F.col("min_part")).alias("diag_2"), _diag(F.col("min_supp")).alias("diag_3"),
        met.alias("metformin"), ins.alias("insulin"), gm.alias("glyburide-metformin"),
        F.when(met.isin("Up", "Down") | ins.isin("Up", "Down") | gm.isin("Up", "Down"), "Ch").otherwise("No")
        .alias("change"),
        F.when((met == "No") & (ins == "No") & (gm == "No"), "No").otherwise("Yes").alias("diabetesMed"),
        F.when(gap.isNull(), "NO").when(gap <= 30, "<30").otherwise(">30").alias("readmitted"),
    )
    return out


ENC_SQL = f"""
li AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret, count(DISTINCT l_suppkey) AS n_supp,
         min(l_partkey) AS min_part, min(l_suppkey) AS min_supp
  FROM lineitem GROUP BY l_orderkey
),
base AS (
  SELECT o.*, c.c_mktsegment, c.c_nationkey, n.n_name, n.n_regionkey, li.*,
         CAST(coalesce(li.n_lines, 0) AS BIGINT) AS nl, CAST(coalesce(li.n_ret, 0) AS BIGINT) AS nr,
         lead(o.o_orderdate) OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey) AS next_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
),
base2 AS (
  SELECT *,
    CASE WHEN nl % 4 = 0 THEN 'No' WHEN nl % 4 = 1 THEN 'Steady' WHEN nl % 4 = 2 THEN 'Up' ELSE 'Down' END AS met,
    CASE WHEN o_orderkey % 5 <= 1 THEN 'No' WHEN o_orderkey % 5 = 2 THEN 'Steady'
         WHEN o_orderkey % 5 = 3 THEN 'Up' ELSE 'Down' END AS ins,
    CASE WHEN nr = 0 THEN 'No' WHEN nr % 2 = 1 THEN 'Steady' ELSE 'Up' END AS gm,
    date_diff('day', CAST(o_orderdate AS DATE), CAST(next_date AS DATE)) AS gap
  FROM base
),
enc AS (
  SELECT o_orderkey AS encounter_id, o_custkey AS patient_nbr,
    CASE WHEN o_orderkey % 17 = 0 THEN '?' ELSE c_mktsegment END AS race,
    o_orderstatus AS gender,
    CASE WHEN o_orderkey % 41 = 0 THEN 'None' ELSE o_orderpriority END AS age,
    CAST(n_regionkey + 1 AS INTEGER) AS admission_type_id,
    CAST(o_orderkey % 30 AS INTEGER) AS disposition_id,
    CASE WHEN o_orderkey % 2 = 0 THEN '?' ELSE n_name END AS specialty,
    CAST(CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE coalesce(n_supp, 0) END AS BIGINT) AS time_in_hospital,
    CASE WHEN o_orderkey % 101 = 0 THEN -nl ELSE nl END AS num_lab,
    CAST(coalesce(qty, 0) AS BIGINT) AS num_med,
    nr AS num_proc,
    {_diag_sql('o_orderkey')} AS diag_1,
    {_diag_sql('min_part')} AS diag_2,
    {_diag_sql('min_supp')} AS diag_3,
    met AS metformin, ins AS insulin, gm AS "glyburide-metformin",
    CASE WHEN met IN ('Up','Down') OR ins IN ('Up','Down') OR gm IN ('Up','Down') THEN 'Ch' ELSE 'No' END AS change,
    CASE WHEN met = 'No' AND ins = 'No' AND gm = 'No' THEN 'No' ELSE 'Yes' END AS "diabetesMed",
    CASE WHEN gap IS NULL THEN 'NO' WHEN gap <= 30 THEN '<30' ELSE '>30' END AS readmitted
  FROM base2
)"""


def with_enc(sql_body: str, *extra_ctes: str) -> str:
    """Prefix an oracle query with the ``enc`` CTE (and optional further CTEs)."""
    ctes = ENC_SQL + "".join("," + c for c in extra_ctes)
    return f"WITH {ctes}\n{sql_body}"
