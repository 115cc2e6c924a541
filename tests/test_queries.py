"""Every query against its SQL on the smallest data set; the others must give rows."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
# Nearest-neighbour, stream and model queries are slow; their own tests cover them too.
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
