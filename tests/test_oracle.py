"""Every registered query against DuckDB on the same Parquet tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registered
from workload.oracle import ORACLE
from workload.queries import QUERIES, drop_scratch
from workload.views import TABLES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLE) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = registered.queries()[name](spark, SF_DIR)
    result = duck.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    spark_rows = _bag(df.columns, [tuple(r) for r in df.collect()])
    drop_scratch(spark)
    assert spark_rows == _bag(columns, result.fetchall())
    assert spark_rows, "a check without rows checks nothing"
