"""Every query against its SQL counterpart in DuckDB, over whole tables."""

import math
import os

import pytest

import __spark_entry__ as entry_module
from veilframe import catalogue

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def multiset(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_counterpart():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, oracle, name):
    got = entry_module.queries()[name](spark, FOLDER)
    wanted = oracle.sql(entry_module.oracle_sql()[name])
    assert sorted(got.columns) == sorted(wanted.columns)
    rows = multiset(got.columns, got.collect())
    assert rows and rows == multiset(wanted.columns, wanted.fetchall())


def test_entry(spark):
    got = entry_module.entry(spark)
    assert got.columns == ["c_custkey", "c_name", "c_acctbal", "o_orderkey", "o_totalprice"]
    assert got.count() > 0
