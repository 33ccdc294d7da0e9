"""Every registered query against its SQL counterpart in DuckDB."""

import pytest
from compare import check, connect

from siltline.plans.contract import queries
from siltline.plans.oracle import oracle_sql

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(queries()) == set(SQL)


@pytest.mark.parametrize("name", queries())
def test_query(spark, con, sf_dir, name):
    assert check(spark, con, sf_dir, queries()[name], SQL[name]) == ""


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
