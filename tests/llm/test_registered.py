"""Registered queries beside their SQL, and the pipeline beside its stages' rules."""

import pytest

import corpus_pipeline
from plenary.llm import neardup, queries
from tests.conftest import SMALL
from tests.llm.fixtures import no_documents, odd_documents
from tests.oracle import connect, difference, spark_rows, sql_rows


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    assert difference(spark_rows(queries.QUERIES[name](spark, SMALL)), sql_rows(connect(SMALL), queries.ORACLES[name])) == ""


@pytest.mark.parametrize("name", ["op3_neardup", "op8_spotsigs"])
def test_one_row_per_document(spark, name):
    docs = queries.table(spark, SMALL, "documents")
    assert queries.QUERIES[name](spark, SMALL).select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
    assert queries.QUERIES[name](spark, SMALL).count() == docs.count()


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        seen[name] = docs.cache()
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert seen["language_id"].where("text is null or not text rlike '\\\\p{L}'").isEmpty()
    assert seen["near_dedup"].count() == neardup.classes(seen["language_id"]).select("class_key").distinct().count()
    assert seen["secrets"].count() == seen["near_dedup"].count() and seen["secrets"].where("text like '%AKIA%'").isEmpty()
    rows = lambda name: seen[name].select("doc_id", "text")
    assert rows("mixing").subtract(rows("secrets")).isEmpty()  # null ids are alike here, as they are not in a join
    assert seen["sentencepiece"].count() == seen["mixing"].count() and seen["sentencepiece"].where("not round_trip").isEmpty()
    for df in seen.values():
        df.unpersist()


def test_stages_of_no_documents(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents(spark).select("doc_id", "text", "lang", "source", "n_chars"), SMALL).isEmpty()
