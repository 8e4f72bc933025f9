"""Every registered query with SQL equals that SQL, values and types, over the whole tables."""

import pytest
from compare import connect, difference

from foldgauge.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert difference(QUERIES[name](spark, sf_dir), connection.sql(SQL[name])) is None


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    frame = entry(spark)
    assert frame.count() > 0 and "macro_f1_mean" in frame.columns
    assert set(oracle_sql()) <= set(queries())
