import corpus_pipeline
import pytest
from parity import compare, connect
from samples import no_documents, odd_documents

from corpusloom.llm.queries import all_queries, all_sql

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        rows = out.collect()
        counts.append(len(rows))
        if stage is not corpus_pipeline.encoding:
            assert out.columns == DOCUMENTS
            if stage is corpus_pipeline.private_data:
                assert {r.doc_id: r.text for r in rows} != {r.doc_id: r.text for r in docs.collect()}
            docs = spark.createDataFrame(rows, docs.schema)
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[4] == counts[5] > 0
    assert corpus_pipeline.run(spark, sf).count() == counts[5]


def test_odd_and_empty_documents(spark, sf):
    for docs in (odd_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert out.count() >= 0
            if stage is not corpus_pipeline.encoding:
                assert out.columns == docs.columns


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_queries_agree_with_their_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, name, all_queries()[name], all_sql()[name]) is None
