"""Every registered query: against its SQL where there is one, else that it gives rows."""

import os

import pytest

import __spark_entry__ as entry
from millrace.plans import ORACLES, QUERIES
from tests.harness import compare, oracle_connection

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
