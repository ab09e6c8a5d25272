"""Rows keep their identity when the planner splits the scan anew between the actions of an operator."""

import itertools
import shutil

import corpus_pipeline
import pytest

from riskframe.llm import common, suffix_dedup, warc

SMALL = "/root/testdata/sf0.001"
CONF = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """The small tables with documents and pages in 24 files."""
    d = tmp_path_factory.mktemp("many")
    for t in ("documents", "pages"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").repartition(24).write.parquet(f"{d}/{t}.parquet")
    shutil.copy(f"{SMALL}/benchmark.parquet", f"{d}/benchmark.parquet")
    return str(d)


@pytest.fixture
def unsteady(spark, monkeypatch):
    """After each written table the planner sees another number of cores."""
    cores = itertools.cycle((16, 4, 24))
    real = common.saved

    def saved(df, name):
        out = real(df, name)
        spark.conf.set(CONF, next(cores))
        return out
    for module in (common, suffix_dedup.common, warc.common):
        monkeypatch.setattr(module, "saved", saved)
    yield
    spark.conf.unset(CONF)


def test_numbers(spark, many_files):
    docs = common.table(spark, many_files, "documents")
    numbered = common.numbered(docs, "row")
    before = {tuple(r) for r in numbered.select("row", "doc_id").collect()}
    try:
        spark.conf.set(CONF, 24)
        assert {tuple(r) for r in numbered.select("doc_id", "row").select("row", "doc_id").collect()} == before
        assert len({r for r, _ in before}) == len(before)
    finally:
        spark.conf.unset(CONF)


@pytest.fixture(scope="module")
def steady(spark, many_files):
    docs = common.table(spark, many_files, "documents")
    out = {name: sorted(map(repr, stage(spark, docs, many_files).select("doc_id").collect())) for name, stage in corpus_pipeline.STAGES[:-1]}
    return out | {"suffix": sorted(map(repr, suffix_dedup.remove(common.texts(docs)).collect()))}


def test_operators(spark, many_files, steady, unsteady):
    docs = common.table(spark, many_files, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert sorted(map(repr, stage(spark, docs, many_files).select("doc_id").collect())) == steady[name], name
    assert sorted(map(repr, suffix_dedup.remove(common.texts(docs)).collect())) == steady["suffix"]


def test_archives(spark, many_files, unsteady):
    pages = common.table(spark, many_files, "pages")
    found = warc.resolved(common.saved(warc.captures(warc.read(warc.write(pages, common.shared_dir(spark, "w"), least=100))), "c"))
    rows = found.selectExpr("response.type AS type", "original.page_id AS first").collect()
    assert len(rows) == pages.count()
    assert all((r["type"] == "revisit") == (r["first"] is not None) for r in rows)
