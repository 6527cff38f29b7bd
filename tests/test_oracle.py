"""Every registered query with SQL gives the same rows in both engines."""

import os

import oracle
import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, connection, name):
    assert oracle.compare(QUERIES[name](spark, FOLDER), connection, SQL[name]) == ""


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
