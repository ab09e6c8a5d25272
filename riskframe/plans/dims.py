"""Lookup dimensions derived from the driver's dimension tables.

The long form ``(mapping, id, description)`` is what the section reader
(:mod:`riskframe.sources.sections`) produces from a multi-section lookup file;
here the same shape is built from ``region`` and ``nation``. A few
descriptions are null (the reference's text ``NULL`` entries) and some ids of
the encounter view have no entry, so both "Unknown" paths are exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.plans.enc import table


def lookup_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    adm = region.select(F.lit("admission_type").alias("mapping"), (F.col("r_regionkey") + 1).cast("int").alias("id"),
                        F.col("r_name").alias("description"))
    disp = nation.select(F.lit("disposition").alias("mapping"), (F.col("n_nationkey") + 1).cast("int").alias("id"),
                         F.when(F.col("n_nationkey") % 8 == 5, F.lit(None).cast("string")).otherwise(F.col("n_name"))
                         .alias("description"))
    return adm.unionByName(disp)


LOOKUP_SQL = """
lk AS (
  SELECT 'admission_type' AS mapping, CAST(r_regionkey + 1 AS INTEGER) AS id, r_name AS description FROM region
  UNION ALL
  SELECT 'disposition', CAST(n_nationkey + 1 AS INTEGER),
         CASE WHEN n_nationkey % 8 = 5 THEN NULL ELSE n_name END FROM nation
)"""
