"""Every query of the subpackage with SQL gives the SQL's rows; every other runs."""

import pytest
from pagelathe.llm import registry
from tests.comparison import assert_same, connection

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    assert_same(QUERIES[name](spark, sf).toPandas(), connection(sf).execute(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_other_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
