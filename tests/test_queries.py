"""Every registered query against its DuckDB statement."""

import os

import pytest

import __spark_entry__ as driver
from checks import compare, oracles
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return compare.open_tables(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(oracles.statements())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    frame = driver.queries()[name](spark, SF_DIR)
    assert compare.difference(frame, tables, driver.oracle_sql()[name]) is None


def test_entry_counts_each_reason(spark):
    assert [tuple(row) for row in driver.entry(spark).collect()] == [
        ("TRANSCRIPTION_MATCH", 73),
        ("TRANSCRIPTION_REVIEW", 57),
        ("WORD_COUNT_DIFFERENCE", 37),
    ]
