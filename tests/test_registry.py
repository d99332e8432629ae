"""Every registered query against its SQL in a second engine."""

import compare
import pytest

import __spark_entry__ as entry
from epiframe.registry import oracle_queries, spark_queries

QUERIES = spark_queries()
SQL = oracle_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, sf, name):
    assert compare.differences(QUERIES[name](spark, sf), duck, SQL[name]) == []


def test_entry_point_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_no_orphans():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())
