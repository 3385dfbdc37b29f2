"""Every registered query against its SQL, on the smallest data set."""

import pytest

from checks.compare import difference
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), SF_DIR, name) is None
