"""Operator 2: WARC archives, written and read back, and captures assembled from their linked records.

Each page becomes a request, a response (or a revisit) and a metadata record, each a gzip member of its own; request and
metadata name the response in WARC-Concurrent-To. Reading yields one row a record; the assembly joins the records of a
capture through these identifiers, wherever they lie, and emits one nested row a capture.

Defined results: a null payload is the empty payload; of equal payloads of ``least`` bytes or more the one with the
smallest key (null keys last, then row order) is the response, the others revisit it; rows with equal keys are captures
of their own; a null URL is the empty URL; an empty table gives no files and no captures. Captures without a request or
metadata record keep nulls there. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import common

DATE = "2024-01-01T00:00:00Z"
#: Copies of the table of repeated payloads, so that one payload's pages go to so many tasks.
SALTS = 16
ROLL = 256 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("file string, offset long, record_id string, type string, uri string, date string, concurrent_to string, refers_to string, "
          "declared_digest string, http string, fields map<string,string>, payload_bytes long, payload_digest string, payload binary")


def record_id(page_id, row: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}/{row}'.encode()).digest()[:16])}>"


def record(kind: str, own_id: str, uri: str, content_type: str, block: bytes, more: dict[str, str]) -> bytes:
    """One record as a gzip member."""
    head = {"WARC-Type": kind, "WARC-Record-ID": own_id, "WARC-Date": DATE, "WARC-Target-URI": uri, **more,
            "Content-Type": content_type, "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v)
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(f"WARC/1.1\r\n{lines}\r\n".encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def capture(page_id, row: int, url: str, payload: bytes, digest: str, refers: str | None) -> list[bytes]:
    """The three records of one page."""
    uri = "".join(c for c in url if c.isprintable()).strip()
    main, at = record_id(page_id, row), urlsplit(uri) if uri else urlsplit("")
    extra = [f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, main + k)}>" for k in ("request", "metadata")]
    path = (at.path or "/") + (f"?{at.query}" if at.query else "")
    get = f"GET {path} HTTP/1.1\r\nHost: {at.netloc}\r\n\r\n".encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    own = {"WARC-Payload-Digest": f"sha256:{digest}"}
    if refers:
        own |= {"WARC-Refers-To": refers, "WARC-Profile": REVISIT}
    about = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
    return [record("request", extra[0], uri, "application/http; msgtype=request", get, {"WARC-Concurrent-To": main}),
            record("revisit" if refers else "response", main, uri, "application/http; msgtype=response", http + (b"" if refers else payload), own),
            record("metadata", extra[1], uri, "application/warc-fields", about, {"WARC-Concurrent-To": main})]


def write(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """Writes the archives of ``pages`` under ``root``; (file, records), one row a file."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    rows = common.numbered(rows, "row").withColumn("digest", F.sha2("html", 256))
    first = (rows.where(F.octet_length("html") >= least).groupBy("digest")
             .agg(F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    dealt = rows.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(first, ["digest", "salt"], "left")
    ready = dealt.select("page_id", "row", "url", "html", "digest", F.col("first.page_id").alias("first_id"),
                         F.when(F.col("first.row") != F.col("row"), F.col("first.row")).alias("first_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, n = None, "", 0
        for batch in batches:
            for r in zip(*batch.columns, strict=True):
                page_id, row, link, page, digest, first_id, first_row = (x.as_py() for x in r)
                if out is None:
                    fs, folder = common.store(root)
                    fs.create_dir(folder)
                    name, n = f"pages-{uuid.uuid4().hex}.warc.gz", 0      # a task tried again writes another file
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                refers = None if first_row is None else record_id(first_id, first_row)
                for data in capture(page_id, row, link, page.encode(), digest, refers):
                    out.write(data)
                    n += 1
                if out.tell() > ROLL:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"file": [f"{root}/{name}"], "records": pa.array([n], pa.int64())})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{root}/{name}"], "records": pa.array([n], pa.int64())})
    return common.saved(ready.mapInArrow(run, "file string, records long"), "warc-files")


def _lines(data: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in data.decode("utf-8", "replace").split("\r\n") if ":" in x)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(stream, file: str, with_payload: bool) -> Iterator[dict]:
    """The records of one archive of gzip members, each read whole and no more than one at a time."""
    data, at, left = b"", 0, True
    while True:
        z, parts = zlib.decompressobj(31), []
        begin = at
        while not z.eof:
            if not data and not (data := stream.read(1 << 20)):
                left = False
                break
            parts.append(z.decompress(data))
            at += len(data) - len(z.unused_data)
            data = z.unused_data
        if not left:
            if at > begin:
                raise ValueError(f"{file} ends inside a record")
            return
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        h = _lines(head)
        block = rest[:int(h["content-length"])]
        kind, http, payload, fields = h["warc-type"], None, None, None
        if kind in ("request", "response", "revisit"):
            http_head, _, payload = block.partition(b"\r\n\r\n")
            http = http_head.decode("utf-8", "replace")
        elif kind == "metadata":
            fields = list(_lines(block).items())
        yield {"file": file, "offset": begin, "record_id": h["warc-record-id"], "type": kind, "uri": h.get("warc-target-uri", ""), "date": h["warc-date"],
               "concurrent_to": h.get("warc-concurrent-to"), "refers_to": h.get("warc-refers-to"), "declared_digest": h.get("warc-payload-digest"),
               "http": http, "fields": fields, "payload_bytes": None if payload is None else len(payload),
               "payload_digest": hashlib.sha256(payload).hexdigest() if kind == "response" else None,
               "payload": payload if with_payload and kind == "response" else None}


_KINDS = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary(), "fields": pa.map_(pa.string(), pa.string())}


def read(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row a record of the archives named in ``files`` (file); file and offset find a record again."""
    names = [x.split()[0] for x in RECORD.replace("map<string,string>", "map").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(some: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in some], _KINDS.get(n, pa.string())) for n in names], names)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, path = common.store(file)
                with fs.open_input_stream(path, compression=None) as stream:
                    some, size = [], 0
                    for r in parse(stream, file, with_payload):
                        some.append(r)
                        size += len(r["payload"] or b"") + 500
                        if size > 8 << 20:
                            yield rows(some)
                            some, size = [], 0
                    yield rows(some)
    n = max(1, files.count())                                     # a task for a few files at most
    return files.select("file").repartition(n).mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row a response or revisit: (record_id, response, request, metadata, refers_to: record).

    Of several requests or metadata records of one capture the one with the smallest identifier counts.
    """
    def linked(kind: str, *columns: str) -> DataFrame:
        return (records.where(F.col("type") == kind).where("concurrent_to is not null").groupBy(F.col("concurrent_to").alias("record_id"))
                .agg(F.min_by(F.struct("record_id", *columns), "record_id").alias(kind)))
    main = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id", "refers_to", F.struct("type", "uri", "date", "http", "declared_digest", "payload_bytes", "payload_digest", "payload", "file", "offset").alias("response"))
    return main.join(linked("request", "uri", "date", "http"), "record_id", "left").join(linked("metadata", "uri", "date", "fields"), "record_id", "left")


def resolved(assembled: DataFrame) -> DataFrame:
    """Captures with the capture that a revisit refers to: its key, payload size and digest (null for responses)."""
    target = assembled.select(F.col("record_id").alias("refers_to"), F.struct(F.col("metadata.fields")["page-id"].alias("page_id"),
                              F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest")).alias("original"))
    first = assembled.where("refers_to is not null").select("refers_to").distinct().join(target, "refers_to")
    return assembled.join(first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))),
                          (assembled.refers_to == first.refers_to) & (F.pmod(F.xxhash64("record_id"), F.lit(SALTS)) == F.col("salt")), "left").drop(first.refers_to).drop("salt")


def from_files(spark: SparkSession, pattern: str, with_payload: bool = False) -> DataFrame:
    """Records of all archives that match a path pattern; Spark lists the files, only names and sizes are read."""
    listed = spark.read.format("binaryFile").load(pattern).select(F.col("path").alias("file"))
    return read(listed, with_payload)


def archive(data: list[bytes]) -> io.BytesIO:
    return io.BytesIO(b"".join(data))
