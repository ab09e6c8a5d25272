"""Shared helpers of the training-data operators: inputs, the shared folder, files in it, word splitting."""

from __future__ import annotations

import ctypes
import re
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import checkpoint_root

#: A word: a maximal run without space and \t \n \v \f \r; the same bytes that ``bytes.split()`` cuts at.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of rows that go to Python at once: bounds what a task holds on both sides, whatever the texts' lengths.
BATCH_BYTES = 4 << 20
#: Rows of a parquet file that a scan decodes at once.
SCAN_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """The session's Arrow batches from now on hold ``BATCH_BYTES`` (Spark's own bound is 64 MB), and its scans decode
    ``SCAN_ROWS`` rows at once (Spark's own 4,096 whole texts take arrays of tens of MB in each task)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id long, text string): a null text is the empty text; other columns stay behind."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in the cluster's shared checkpoint folder; as a URI, so that executors resolve it alike."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root if '://' in root or root.startswith('file:') else 'file://' + root}/{name}-{uuid.uuid4().hex[:12]}"


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder in the shared store (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of a row's place in its file; the file's number stands above them.
PLACE_BITS = 38


def numbered(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a number for each row, the same whenever it is read again, however the scan is split.

    The number is that of the row's file (by name) and its place in it. What isn't a plain scan of files is written to
    the shared folder first. The files' names, a row each, are broadcast: the driver lists them anyway.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if not re.search(r"Relation .*parquet", plan) or re.search(r"Repartition|Rebalance|Join|Aggregate|Sort|Window|Limit|Sample|MapIn|Generate|Union|Distinct|Python|FlatMap|InMemory|LocalRelation|Range", plan):
        df = saved(df, "rows")
    meta = df.metadataColumn("_metadata")
    names = sorted(r[0] for r in df.select(meta["file_path"].alias("f")).distinct().collect())
    files = df.sparkSession.createDataFrame([(f, i << PLACE_BITS) for i, f in enumerate(names)], f"{column}_file string, {column}_base long")
    placed = df.withColumns({f"{column}_path": meta["file_path"], f"{column}_index": meta["row_index"]})
    found = placed.join(F.broadcast(files), F.col(f"{column}_path") == F.col(f"{column}_file"))
    return found.select(*[F.col(f"`{c}`") for c in df.columns if c != column], (F.col(f"{column}_base") + F.col(f"{column}_index")).alias(column))


def give_back() -> None:
    """Hands what a finished task took back to the system, as its Python worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # of the C library, where it has it
    if trim:
        trim(0)


def fewer(df: DataFrame, factor: int = 8) -> DataFrame:
    """``df``, the outcome of a shuffle and much smaller than the documents, in fewer and larger tasks."""
    return df.coalesce(max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // factor))


def first_by(df: DataFrame, order: Column, rows: int) -> DataFrame:
    """The ``rows`` rows that come first by a 64-bit hash. Only rows under a bound that leaves little more than these are
    ordered, so a task brings a few rows, not ``rows`` of its own; were the bound too low, all rows would be."""
    n = df.count()
    if n > 4 * rows:
        some = df.where(order < int(-(1 << 63) + (rows + 8 * rows ** 0.5 + 16) / n * (1 << 64)))
        if some.count() >= rows:
            df = some
    return df.orderBy(order).limit(rows)
