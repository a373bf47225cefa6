"""The training-data queries: against DuckDB where SQL can express them, and the pipeline."""

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from checks import compare
from tests.llm import brute
from verbalance.llm import oracles, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.statements()))
def test_query_against_its_statement(spark, name):
    frame = driver.queries()[name](spark, SF_DIR)
    tables = compare.open_tables(SF_DIR)
    assert compare.difference(frame, tables, driver.oracle_sql()[name]) is None


def test_every_query_is_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(driver.queries())


def test_pipeline_stages_take_effect(spark):
    docs = queries.documents(spark, SF_DIR)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, SF_DIR).cache()
        after = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert docs.columns == columns and set(after) <= set(before)
        if name == "exact dedup":
            assert sorted(i for i, _ in after) == sorted(r[0] for r in brute.exact_dedup(before) if r[3])
        if name == "near dedup":
            kept = [r[0] for r in brute.near_duplicates(before, 5) if r[3]]
            assert sorted(i for i, _ in after) == sorted(kept)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()
