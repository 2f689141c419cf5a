"""Collects the registered queries and what they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablespan.plans.tables import Table
from tablespan.sources.branches import scan_function
from tablespan.sources.shared import kept, new_folder

__all__ = ["ORACLES", "QUERIES", "given", "kept", "new_folder", "path_of", "query", "read"]

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that must agree with it."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def path_of(folder: str, table: str) -> str:
    return f"{folder}/{table}.parquet"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(path_of(folder, table))


def given(folder: str, table: str) -> Table:
    """One of the given tables as a table of a single delegated branch."""
    return Table(table, (scan_function("read_parquet", path_of(folder, table)),))
