"""The corpus pipeline stage by stage on small documents, and the registered SQL of the operators."""

import hashlib

import corpus_pipeline
import duckdb
import pytest

from riskframe.llm import common, langid, queries
from tests.llm.test_operators import EDGE, SCHEMA, prose

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    leak = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    rows = [(i, t, "en", "src", 1, "x", 5, "y") for i, t in EDGE] + [(50, prose(60, 70) + " " + leak, "en", "src", 0, "", 0, ""), (51, prose(300, 71), "en", "src", 0, "", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "encoding":
            assert out.columns == docs.columns
            kept[name] = sorted((r["doc_id"] for r in out.collect()), key=repr)
            docs = spark.createDataFrame(out.collect(), SCHEMA)
    assert not {1, 2, 3} & set(kept["language"]) and {5, 6, 51} < set(kept["language"])
    assert kept["near_duplicates"].count(5) == 1 and 6 not in kept["near_duplicates"]
    assert 50 not in kept["decontamination"] and 51 in kept["decontamination"]
    assert 11 in kept["decontamination"] and 11 not in kept["secrets"] and 51 in kept["secrets"]
    text = dict(rows_[:2] for rows_ in rows)[51]
    last = {r["doc_id"]: r for r in out.collect()}
    assert set(last) == set(kept["secrets"]) and last[51]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_stages_on_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    found = queries.QUERIES[name](spark, SMALL)
    columns = sorted(found.columns)
    want = c.sql(queries.ORACLES[name]).df()
    assert sorted(want.columns) == columns
    norm = lambda df: sorted(tuple(None if x != x or x is None else x for x in r) for r in df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False))  # noqa: E731, PLR0124
    assert sorted(map(repr, norm(found.toPandas()[columns]))) == sorted(map(repr, norm(want))) or [tuple(r) for r in norm(want)] == norm(found.toPandas())


def test_scans_and_slices_are_small(spark, tmp_path):
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "4096")
    docs = [(i, "x" * 100) for i in range(3 * common.SCAN_ROWS)]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    read = common.texts(common.table(spark, str(tmp_path), "documents"))
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) == common.SCAN_ROWS
    assert sorted(map(tuple, read.collect())) == docs
    some = [[len(x) for x in p] for p in langid.parts(["a" * 300_000] * 8)]
    assert sum(map(len, some)) == 8 and max(map(sum, some)) <= 1_300_000
