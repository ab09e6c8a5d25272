"""Scans and sinks.

Text sources are read with an explicit schema when one is known (inference is
an extra pass over the file); NA-like tokens become NULL at scan time so every
later operator sees one missing-value encoding. Sinks are Spark writers:
partitioned parquet for splits (partition pruning on read), CSV / JSON for
reports, and a read-back check that compares counts and schema.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.core import NA_TOKENS, is_string_type, normalize_tokens, qcol

# --- fixed values --------------------------------------------------------------
ENCODINGS = ["utf-8", "ISO-8859-1", "windows-1252"]
# --------------------------------------------------------------------------------


# S1 -------------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema=None, encoding: str = ENCODINGS[0],
             na_tokens: Sequence[str] = NA_TOKENS, header: bool = True) -> DataFrame:
    """CSV scan with header, explicit schema (or inference), encoding, and NA tokens -> NULL on strings."""
    r = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    return df.select(*[normalize_tokens(qcol(f.name), na_tokens).alias(f.name) if is_string_type(f.dataType)
                       else qcol(f.name) for f in df.schema.fields])


def detect_encoding(spark: SparkSession, path: str) -> str:
    """The first of ENCODINGS that the files' bytes fit, from one scan of undecoded lines: UTF-8 if every line is valid;
    else Latin-1 unless bytes 0x80-0x9F occur, which are control characters there and letters and quotes in cp1252."""
    raw = F.col("value").cast("binary")
    c1 = F.decode(raw, "ISO-8859-1").rlike("[\\x80-\\x9f]")
    bad, late = spark.read.text(path).select(F.is_valid_utf8("value").alias("ok"), c1.alias("c1")) \
        .agg(F.count_if(~F.col("ok")), F.count_if(F.col("c1"))).first()
    return ENCODINGS[0] if not bad else ENCODINGS[2] if late else ENCODINGS[1]


def read_csv_any_encoding(spark: SparkSession, path: str, schema=None, na_tokens: Sequence[str] = NA_TOKENS) -> tuple[DataFrame, str]:
    """A CSV scan in the encoding that its bytes fit (one scan decides); ``(rows, encoding)``."""
    enc = detect_encoding(spark, path)
    if enc != ENCODINGS[2]:
        return read_csv(spark, path, schema, enc, na_tokens), enc
    df = read_csv(spark, path, schema, ENCODINGS[1], na_tokens)          # the scan knows no cp1252: it differs in 27 characters
    late = {bytes([b]).decode("latin-1"): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
    return df.select(*[F.translate(qcol(f.name), "".join(late), "".join(late.values())).alias(f.name) if is_string_type(f.dataType)
                       else qcol(f.name) for f in df.schema.fields]), enc


def load_stats(df: DataFrame, entity: str | None = None) -> DataFrame:
    """Rows, columns and distinct entities of a freshly loaded table (one aggregate)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if entity:
        aggs.append(F.count_distinct(qcol(entity)).alias("entities"))
    return df.agg(*aggs).withColumn("columns", F.lit(len(df.columns)))


# S3 -------------------------------------------------------------------------------
def head(df: DataFrame, k: int, order: Sequence[str]) -> DataFrame:
    """First ``k`` rows in a stated order (a top-k; deterministic unlike an unordered limit)."""
    return df.orderBy(*[qcol(c) for c in order]).limit(k)


# S6 / S7 / S8 ---------------------------------------------------------------------
def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def read_back_check(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Compare row count and column set of what was written with what reads back."""
    r = spark.read.format(fmt).option("header", True).load(path) if fmt == "csv" else \
        spark.read.format(fmt).load(path)
    same_cols = sorted(r.columns) == sorted(df.columns)
    return r.agg(F.count(F.lit(1)).alias("rows_read")).withColumn(
        "rows_written", df.agg(F.count(F.lit(1))).scalar()).withColumn("same_columns", F.lit(same_cols))


# S5 -------------------------------------------------------------------------------
def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a ``partitionBy("split")`` table: the filter prunes partitions (only that folder is read)."""
    return spark.read.parquet(path).where(F.col("split") == split)


def write_reports(reports: Mapping[str, DataFrame], root: str) -> None:
    """Each report -- long rows ``(item, value, ...)`` -- as JSON lines under ``root/<name>_report``."""
    for name, df in reports.items():
        write_table(df, f"{root}/{name}_report", "json")


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """All reports under ``root`` as one table, with the name of each."""
    df = spark.read.json(f"{root}/*_report")
    return df.withColumn("report", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]*)_report/[^/]*$", 1))


# S10 ------------------------------------------------------------------------------
def read_results_dir(spark: SparkSession, pattern: str) -> DataFrame:
    """Result files (multi-line JSON) or folders of them; the model is what precedes ``_results_`` in the file's or, for a
    written table, the folder's name."""
    df = spark.read.option("multiLine", True).json(pattern)
    return df.withColumn("model", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]*)_results_[^/]*(/[^/]*)?$", 1))
