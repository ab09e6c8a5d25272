"""Operator 6: language identification by Bayesian fusion of evidence.

Per row the text's likelihood under each language (hashed byte trigrams, tempered, since neighbouring trigrams depend on
each other) is combined with the declared markup language, the address suffix and a prior of its host. All tables come
from grouped aggregation over all rows: trigram counts by declared language, then, from the text's posteriors alone, how
often a language is declared as, and found under, what, and how often it occurs on a host. Host priors are smoothed
towards their parent domain's, and those towards the overall shares.

Defined results: a row is rejected (``kept`` false) if its text holds no letter or no language reaches ``least``. A null
text is the empty text; null declarations, suffixes and hosts are values of their own; repeated rows get equal results;
an empty table, or one in which nothing is declared, gives rows without a language, all rejected. Other columns are not
read. Results carry the posterior to six digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import common

BUCKETS = 1 << 14
#: Trigrams that a text's likelihood counts as, at most: the rest adds little that is independent.
EFFECTIVE = 40
#: Rows that a parent's shares weigh in a host's prior; added rows for a declaration or a suffix not met.
HOST_ROWS, ADDED = 20.0, 0.5
#: Languages that the model may have: the most declared ones. Rarer declarations (junk, in pages) are one value, as evidence.
MAX_LANGUAGES, RARE = 200, "\x00rare"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r0123456789", b" " * 15)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all trigrams of all texts, and each text's first; a text's last two places hold BUCKETS."""
    raw = [x.encode().translate(_LOWER).translate(_SPACE) + b"  " for x in texts]
    n = np.fromiter(map(len, raw), np.int64, len(raw))
    b = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    ends = np.cumsum(n)
    out = np.full(len(b), BUCKETS, np.int32)
    if len(b) > 2:
        x = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        out[:-2] = ((x * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int32)
    out[ends - 1] = BUCKETS
    out[ends - 2] = BUCKETS
    return out, ends - n


def parts(values: list[str | None], chars: int = 1_000_000) -> Iterator[list[str]]:
    some: list[str] = []
    size = 0
    for v in values:
        some.append(v or "")
        size += len(some[-1])
        if size > chars:
            yield some
            some, size = [], 0
    if some:
        yield some


def fit(rows: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages and the log probability of each bucket in each (BUCKETS + 1 rows, the last zero); all rows count."""
    often = rows.where("declared is not null").groupBy("declared").count().orderBy(F.desc("count"), "declared").limit(MAX_LANGUAGES)
    langs = sorted(r["declared"] for r in often.collect())
    rows = rows.where(F.col("declared").isin(langs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(langs)}
        total = np.zeros((len(langs), BUCKETS + 1), np.int64)
        for batch in batches:
            declared = [place[x] for x in batch.column("declared").to_pylist()]
            at = 0
            for some in parts(batch.column("text").to_pylist()):
                ids, first = trigrams(some)
                lang = np.repeat(declared[at:at + len(some)], np.diff(np.append(first, len(ids))))
                total += np.bincount(lang * (BUCKETS + 1) + ids, minlength=total.size).reshape(total.shape)
                at += len(some)
        lang, bucket = np.nonzero(total)
        common.give_back()
        yield pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "n": total[lang, bucket]})
    found = (rows.select("text", "declared").mapInArrow(count, "lang int, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())         # languages x buckets at most
    table = np.full((BUCKETS + 1, len(langs)), smoothing)
    table[found["bucket"], found["lang"]] += found["n"]
    table[BUCKETS] = 0
    with np.errstate(divide="ignore"):
        logs = np.log(table / table.sum(axis=0, keepdims=True)) if len(langs) else table
    logs[BUCKETS] = 0
    return langs, logs.astype(np.float32)


def likelihoods(rows: DataFrame, logs: np.ndarray) -> DataFrame:
    """``rows`` (doc_id, text, declared, suffix, host) with ``ll`` (tempered log likelihoods) and ``lettered``, without text."""
    sent = rows.sparkSession.sparkContext.broadcast(logs)             # languages x buckets: at most 13 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.ascontiguousarray(sent.value.T)
        for batch in batches:
            at = 0
            for some in parts(batch.column("text").to_pylist()):
                ids, first = trigrams(some)
                n = np.diff(np.append(first, len(ids))) - 2
                ll = np.stack([np.add.reduceat(t[ids], first, dtype=np.float64) for t in table], 1) if len(table) else np.zeros((len(some), 0))
                ll *= (np.minimum(n, EFFECTIVE) / np.maximum(n, 1))[:, None]
                lettered = [any(c.isalpha() for c in x) for x in some]
                own = batch.slice(at, len(some))
                yield pa.RecordBatch.from_arrays([own.column(c) for c in ("doc_id", "declared", "suffix", "host")] + [
                    pa.array(list(ll), pa.list_(pa.float64())), pa.array(lettered)], ["doc_id", "declared", "suffix", "host", "ll", "lettered"])
                at += len(some)
        common.give_back()
    return rows.mapInArrow(run, "doc_id long, declared string, suffix string, host string, ll array<double>, lettered boolean")


def _softmax(col: str) -> Column:
    up = F.transform(col, lambda x: F.exp(x - F.array_max(col)))
    return F.transform(up, lambda x: x / F.aggregate(up, F.lit(0.0), lambda a, b: a + b))


def _sums(n: int) -> Column:
    return F.array(*[F.sum(F.col("p")[i]) for i in range(n)])


def _logs(table: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """key, log P(key | language) + constant: shares within each language of the summed posteriors, none zero."""
    total = table.agg(F.array(*[F.sum(F.col("s")[i]) for i in range(n)]).alias("t"), F.count("*").alias("k"))
    return table.crossJoin(F.broadcast(total)).select(key, F.zip_with("s", "t", lambda s, t: F.log((s + ADDED) / (t + ADDED * F.col("k")))).alias(name))


def identify(rows: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, lang, posterior, text_lang, kept) of each of ``rows`` (doc_id, text, declared, suffix, host)."""
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "declared", "suffix", "host")
    langs, logs = fit(rows)
    n = len(langs)
    if not n:
        return rows.select("doc_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("posterior"),
                           F.lit(None).cast("string").alias("text_lang"), F.lit(False).alias("kept"))
    scored = likelihoods(rows, logs).withColumn("p", _softmax("ll"))
    rare = F.col("declared").isNotNull() & ~F.col("declared").isin(langs)
    scored = scored.withColumn("declared", F.when(rare, F.lit(RARE)).otherwise(F.col("declared")))
    for c in ("declared", "suffix", "host"):
        scored = scored.withColumn(c, F.coalesce(c, F.lit("")))
    scored = common.saved(scored, "language-evidence")
    lettered = scored.where("lettered")
    declared = _logs(lettered.groupBy("declared").agg(_sums(n).alias("s")), "declared", n, "by_declared")
    suffix = _logs(lettered.groupBy("suffix").agg(_sums(n).alias("s")), "suffix", n, "by_suffix")
    hosts = common.saved(lettered.groupBy("host").agg(_sums(n).alias("s")), "hosts")
    parent = F.when(F.size(F.split("host", "[.]")) > 2, F.expr("substring_index(host, '.', -2)")).otherwise(F.lit(""))
    hosts = hosts.withColumn("parent", parent)
    parents = hosts.groupBy("parent").agg(F.array(*[F.sum(F.col("s")[i]) for i in range(n)]).alias("ps"))
    overall = hosts.agg(F.array(*[F.sum(F.col("s")[i]) for i in range(n)]).alias("os"))
    size = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)
    parents = parents.crossJoin(F.broadcast(overall)).select("parent", F.zip_with("ps", "os", lambda p, o: (p + HOST_ROWS * (o + ADDED) / (size("os") + ADDED * n)) / (size("ps") + HOST_ROWS)).alias("pp"))
    prior = hosts.join(parents, "parent").select("host", F.zip_with("s", "pp", lambda s, p: F.log((s + HOST_ROWS * p) / (size("s") + HOST_ROWS))).alias("by_host"))
    whole = scored
    for table, key in ((declared, "declared"), (suffix, "suffix"), (prior, "host")):
        whole = whole.join(table, key, "left")
    add = lambda a, b: F.zip_with(a, F.coalesce(b, F.array_repeat(F.lit(0.0), n)), lambda x, y: x + y)
    fused = add(add(add("ll", F.col("by_declared")), F.col("by_suffix")), F.col("by_host"))
    names = F.array(*[F.lit(x) for x in langs])
    best = F.array_max("post")
    place = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return (whole.withColumn("fused", fused).withColumn("post", _softmax("fused"))
            .select("doc_id", F.when(F.col("lettered"), place("post")).alias("lang"), F.round(best, 6).alias("posterior"),
                    F.when(F.col("lettered"), place("ll")).alias("text_lang"), (F.col("lettered") & (best >= least)).alias("kept")))


def of_documents(docs: DataFrame) -> DataFrame:
    """The operator's rows from a documents table: the source is the host, ``lang`` the declaration; no address."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("declared"),
                       F.lit(None).cast("string").alias("suffix"), F.col("source").cast("string").alias("host"))


def of_pages(pages: DataFrame) -> DataFrame:
    """The operator's rows from a pages table: the html's lang attribute, the address's host and its last label."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z]+://(?:[^/@]*@)?([^/:?#]+)", 1))
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z]+)", 1))
    visible = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    return pages.select(F.col("page_id").cast("long").alias("doc_id"), visible.alias("text"), F.when(declared != "", declared).alias("declared"),
                        F.when(host != "", F.regexp_extract(host, r"([^.]+)$", 1)).alias("suffix"), F.when(host != "", host).alias("host"))
