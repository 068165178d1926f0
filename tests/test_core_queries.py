"""Every core query with SQL gives the SQL's rows; every other runs."""

import pytest
from pagelathe import plans
from tests.comparison import assert_same, connection

QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    c = connection(sf)
    assert_same(QUERIES[name](spark, sf).toPandas(), c.execute(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_other_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()
