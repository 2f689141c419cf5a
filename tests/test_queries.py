"""Every registered query against its SQL twin on the given tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{FOLDER}/{table}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return connection


def cell(value):
    if isinstance(value, float):
        return float(f"{value:.10g}") + 0.0
    if isinstance(value, Decimal):
        return ("decimal", value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(cell(row[i]) for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, database, name):
    result = contract.queries()[name](spark, FOLDER)
    actual = rows_of(result.columns, result.collect())
    sql = contract.oracle_sql()[name]
    answer = database.execute(sql)
    columns = [d[0] for d in answer.description]
    expected = rows_of(columns, answer.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert len(actual) == len(expected)
    assert actual == expected
    assert actual, "a query should have rows to compare"


def test_entry(spark):
    assert contract.entry(spark).count() == 5
