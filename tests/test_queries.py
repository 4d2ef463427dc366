"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_every_query_has_sql():
    """But for corpus operators, whose tests are beside them."""
    apart = {"pipeline", *(entry.llm.queries() if entry.llm else ())}
    assert set(entry.queries()) - apart == set(entry.oracle_sql()) - apart
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, oracle, name):
    same, count, why = compare(spark, oracle, SF, name)
    assert same, why
    assert count > 0
