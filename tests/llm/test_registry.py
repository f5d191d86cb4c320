"""The package's queries against their SQL, and the pipeline's stages."""

import pytest

import corpus_pipeline
from aerostrata.llm.common import table
from aerostrata.llm.queries import llm_oracles, llm_queries
from tests.compare import compare

NAMES = sorted(llm_oracles())


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in llm_queries()] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]


@pytest.mark.parametrize("name", NAMES)
def test_sql(spark, duck_sf, sf, name):
    assert compare(spark, duck_sf, sf, name, llm_queries()[name], llm_oracles()[name]) == ""


def test_stages(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        now = {r.doc_id: r.text for r in docs.collect()}
        assert set(now) <= set(before)
        before = now
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    pieces = corpus_pipeline.sequences(spark, docs, sf).collect()
    assert {p.doc_id for p in pieces} == set(before)


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
