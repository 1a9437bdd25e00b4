"""The pipeline and the registered queries on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from revtide import llm
from revtide.llm.common import table
from tests.compare import compare, database

SMALL = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    names = [n for n in queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert queries()["pipeline"] is corpus_pipeline.run
    assert set(llm.ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(llm.QUERIES))
def test_queries_cover_their_table(spark, name):
    frame = queries()[name](spark, SMALL)
    n = table(spark, SMALL, "pages" if name[:4] in ("op3_", "op7_") else "documents").count()
    rows = frame.count()
    if name.startswith("op1_"):
        assert rows >= n and frame.select("doc_id").distinct().count() == n
    elif name.startswith("op12_"):
        ranks = frame.groupBy("item_id").agg(F.max("rank").alias("most"), F.count("*").alias("n")).collect()
        assert len(ranks) == table(spark, SMALL, "benchmark").count() and all(r.most == r.n <= 50 for r in ranks)
    elif not name.startswith("op2_"):
        assert rows == n


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_queries_equal_their_sql(spark, name):
    _, fault = compare(spark, database(SMALL), SMALL, name, llm.QUERIES[name], llm.ORACLES[name])
    assert fault is None


def test_stages_keep_what_they_must(spark):
    docs = table(spark, SMALL, "documents")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if number + 1 < len(corpus_pipeline.STAGES):
            assert out.dtypes == docs.dtypes
            assert 0 < out.count() <= docs.count()


def test_run_packs_what_the_stages_keep(spark):
    docs = table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()} == kept
