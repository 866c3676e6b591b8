"""Every registered query equals its SQL, and no plan multiplies rows blindly."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from tests.conftest import plan
from urbanlake.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.queries()) >= set(QUERIES) and set(entry.queries()) >= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    result, _ = compare(spark, con, SF, name)
    assert result == "ok"


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_nested_loop(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
