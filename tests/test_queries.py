"""Every registered query against DuckDB on the smallest driver data."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks import layout, operators
from checks.compare import compare, connect
from checks.reports import report_queries

SF = "/root/testdata/sf0.001"
NAMES = sorted({**operators.QUERIES, **layout.QUERIES, **report_queries()})
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver data not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    assert compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_without_the_training_data_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    with pytest.warns(UserWarning, match="left out"):
        assert set(entry.queries()) == set(NAMES)
