"""A training corpus from raw documents: language, near duplicates, test passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; what it returns is written and read again as
the next stage's docs. All but the last return the columns of documents.

Rows are told apart by their place in ``docs``, so null, repeated or tied doc_ids change nothing. Defined results: a
null text is the empty text: it has no language and goes in the first stage; an empty table passes all stages empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe, common, decontaminate, langid, secrets, simhash

ROW = "_row_of_docs"


def _numbered(docs: DataFrame) -> DataFrame:
    return common.numbered(docs, ROW)


def _as_key(numbered: DataFrame) -> DataFrame:
    """(doc_id: the row's place, text)."""
    return common.texts(numbered, key=ROW)


def _without(numbered: DataFrame, rows: DataFrame) -> DataFrame:
    """``numbered`` without the rows whose place is in ``rows`` (doc_id); their table is written first, so that its size
    is known when the join is planned."""
    gone = common.saved(rows.select(F.col("doc_id").alias(ROW)).distinct(), "rows-to-drop")
    return numbered.join(gone, ROW, "left_anti").drop(ROW)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    numbered = _numbered(docs)
    found = langid.identify(langid.of_documents(numbered.withColumn("doc_id", F.col(ROW))))
    return _without(numbered, found.where(~F.col("kept")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id (null ids last, then by place)."""
    numbered = _numbered(docs)
    of = simhash.near_duplicates(_as_key(numbered), shingle=4, max_bits=4).select(F.col("doc_id").alias(ROW), "component_id")
    of = common.saved(of.join(numbered.select(ROW, "doc_id"), ROW), "near-duplicates")
    first = of.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("first"), F.count("*").alias("n")).where("n > 1")
    others = of.join(first, "component_id").where(F.col(f"first.{ROW}") != F.col(ROW))
    return _without(numbered, others.select(F.col(ROW).alias("doc_id")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    numbered = _numbered(docs)
    return _without(numbered, decontaminate.find(_as_key(numbered), common.table(spark, sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without secrets."""
    numbered = _numbered(docs)
    found = secrets.scan(_as_key(numbered), common.shared_dir(spark, "secret-ledger"), keys=["doc_id"])
    return _without(numbered, found.where(F.size("spans") > 0))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): token ids, with digests of the ids and of what they decode to."""
    done = bpe.encode(common.texts(docs), public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secret_scan), ("encoding", encoding)]

#: SQL can't express the fusion of evidence, the alignment and the encoding; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
