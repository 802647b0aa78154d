"""Every registered query against its SQL text on an independent engine."""

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as entry
from larderline import registry
from oracles import oracle_queries

# The library's own queries; those of the optional part are held to their SQL in tests/llm.
QUERIES, ORACLES = registry.QUERIES, oracle_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
