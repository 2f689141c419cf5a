"""Registered queries: each an operator at work on the given tables, with its SQL twin."""

from tablespan.queries import aggregates, calls, layouts, relational, scans, sql_tables  # noqa: F401
from tablespan.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
