"""Multi-section lookup files.

A file holds several ``<name>_id,description`` blocks; a block runs from its header line to the next header. The files are
read by a data source whose partitions are byte ranges: a range yields the lines that begin in it, each with its byte
offset and the last header seen in the range. Lines before the first header of their range take the header that the ranges
before hand over: a table of one row a range, not a sort of the lines. Bodies are parsed with ``from_csv`` (quoted commas),
ids are coerced to int (bad ids dropped), descriptions are stripped of spaces and quotes and NA tokens become null.
Result: one long dimension ``(mapping, id, description)``.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from riskframe.functions.core import NA_TOKENS
from riskframe.session import cut_lineage

# --- fixed values --------------------------------------------------------------
HEADER_MARK = "_id,description"
RANGE_BYTES = 64 << 20
# --------------------------------------------------------------------------------


class ByteRange(InputPartition):
    def __init__(self, file: str, number: int, first: int, stop: int):
        super().__init__(file)
        self.file, self.number, self.first, self.stop = file, number, first, stop


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


class SectionLines(DataSource):
    """Lines of text files with their place and header; options: path, header_mark, range_bytes."""

    @classmethod
    def name(cls) -> str:
        return "section_lines"

    def schema(self) -> str:
        return "file string, range int, offset long, line string, valid boolean, header string, is_header boolean"

    def reader(self, schema) -> DataSourceReader:
        return SectionReader(self.options)


class SectionReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.mark = options["path"], options.get("header_mark", HEADER_MARK).encode()
        self.size = int(options.get("range_bytes", RANGE_BYTES))

    def partitions(self) -> list[ByteRange]:
        fs, path = _store(self.path)
        own = fs.get_file_info(path)
        files = [own] if own.is_file else [f for f in fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True)) if f.is_file]
        return [ByteRange(f.path, k, at, min(at + self.size, f.size)) for f in sorted(files, key=lambda f: f.path)
                if not f.base_name.startswith(("_", ".")) for k, at in enumerate(range(0, f.size, self.size))]

    def read(self, partition: ByteRange) -> Iterator[tuple]:
        """The lines that begin in the range: one that goes on beyond its end is read to its own end."""
        if partition is None:                                    # no files, or empty ones
            return
        fs, _ = _store(self.path)
        with io.BufferedReader(fs.open_input_file(partition.file)) as f:
            at = partition.first
            if at:                                               # the line in which the range begins belongs to the one before
                f.seek(at - 1)
                at += len(f.readline()) - 1
            f.seek(at)
            header = None
            while at < partition.stop:
                raw = f.readline()
                if not raw:
                    return
                line = raw.rstrip(b"\r\n")
                is_header = self.mark in line
                try:
                    text, valid = line.decode(), True
                except UnicodeDecodeError:
                    text, valid = line.decode("latin-1"), False
                if is_header:
                    header = text
                yield partition.file, partition.number, at, text, valid, header, is_header
                at += len(raw)


def read_lines(spark: SparkSession, path: str, header_mark: str = HEADER_MARK, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file, range, offset, line, header, is_header)``, read in one scan and written once to the shared folder.

    A file with a byte sequence that isn't UTF-8 is Latin-1 as a whole: its other lines are decoded anew from their bytes."""
    spark.dataSource.register(SectionLines)
    raw = cut_lineage(spark.read.format("section_lines").option("header_mark", header_mark).option("range_bytes", range_bytes).load(path))
    other = [r["file"] for r in raw.where("NOT valid").select("file").distinct().collect()]                    # files, listed anyway
    if other:
        again = F.col("file").isin(other) & F.col("valid")
        as_latin = lambda c: F.when(again, F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")).otherwise(F.col(c))
        raw = raw.withColumns({"line": as_latin("line"), "header": as_latin("header")})
    return raw.drop("valid")


def with_headers(lines: DataFrame) -> DataFrame:
    """Lines with the header that stands before them, be it in an earlier range of their file."""
    last = lines.groupBy("file", "range").agg(F.max_by("header", "offset").alias("own"))                       # a row a range
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select("file", "range", F.last("own", ignorenulls=True).over(before).alias("handed"))
    return lines.join(handed, ["file", "range"]).withColumn("header", F.coalesce("header", "handed")).drop("handed")


def parse_sections(lines: DataFrame) -> DataFrame:
    """Lines with their headers -> ``(mapping, id, description)``."""
    body = with_headers(lines).where(~F.col("is_header") & F.col("header").isNotNull() & (F.trim("line") != "") & (F.trim("line") != ","))
    parsed = body.select(F.regexp_replace(F.split(F.trim("header"), ",").getItem(0), "_id", "").alias("mapping"),
                         F.from_csv(F.col("line"), "id STRING, description STRING").alias("r"))
    desc = F.btrim(F.col("r.description"), F.lit(' "'))
    out = parsed.select("mapping", F.col("r.id").try_cast("double").alias("_id"),
                        F.when(F.col("r.description").isin(NA_TOKENS) | F.col("r.description").isNull(), F.lit(None)).otherwise(desc).alias("description"))
    return out.where(F.col("_id").isNotNull()).select("mapping", F.col("_id").cast("int").alias("id"), "description")


def read_sections(spark: SparkSession, path: str, header_mark: str = HEADER_MARK, range_bytes: int = RANGE_BYTES) -> DataFrame:
    return parse_sections(read_lines(spark, path, header_mark, range_bytes))


def write_sections(body: DataFrame, headers: DataFrame, path: str, chunk_rows: int = 100_000) -> None:
    """Write a multi-section text file set from ``body (sec, pos, line)`` and ``headers (sec, line)``.

    Each section is cut into chunks of ``chunk_rows`` consecutive positions and
    every chunk is written with its own copy of the header, so a file never
    starts mid-section and no task holds more than a chunk of any section.
    """
    n = int(body.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = body.withColumn("chunk", F.floor(F.col("pos") / chunk_rows))
    hdr = b.select("sec", "chunk").distinct().join(headers, "sec").select("sec", "chunk", F.lit(-1).cast("long")
                                                                          .alias("pos"), "line")
    rows = b.select("sec", "chunk", F.col("pos").cast("long"), "line").unionByName(hdr)
    rows.repartition(n, "sec", "chunk").sortWithinPartitions("sec", "chunk", "pos").select("line") \
        .write.mode("overwrite").text(path)
