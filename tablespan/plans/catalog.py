"""A named set of tables, looked up by namespace path and name."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tablespan.plans.scan import scan
from tablespan.plans.tables import Table, VersionedTable

Namespace = tuple[str, ...]


class UnknownTableError(LookupError):
    """The catalog holds no such table."""


class Catalog:
    """Definitions only; every read goes through :func:`tablespan.plans.scan.scan`."""

    def __init__(self, name: str, default_namespace: Namespace = ("main",)):
        self.name = name
        self.default_namespace = default_namespace
        self._tables: dict[tuple[Namespace, str], Table | VersionedTable] = {}

    def add(self, table: Table | VersionedTable, namespace: Namespace | None = None) -> None:
        key = (namespace or self.default_namespace, table.name)
        if key in self._tables:
            raise ValueError(f"table {'.'.join(key[0])}.{table.name} is defined already")
        self._tables[key] = table

    def namespaces(self, parent: Namespace = ()) -> list[Namespace]:
        """The namespaces exactly one level below ``parent``."""
        level = len(parent) + 1
        known = {ns for ns, _ in self._tables if len(ns) >= level}
        return sorted({ns[:level] for ns in known if ns[: level - 1] == parent})

    def tables(self, namespace: Namespace | None = None) -> list[str]:
        wanted = namespace or self.default_namespace
        return sorted(name for ns, name in self._tables if ns == wanted)

    def has(self, name: str, namespace: Namespace | None = None) -> bool:
        return (namespace or self.default_namespace, name) in self._tables

    def table(self, name: str, namespace: Namespace | None = None) -> Table | VersionedTable:
        key = (namespace or self.default_namespace, name)
        if key not in self._tables:
            raise UnknownTableError(f"{self.name} has no table {'.'.join(key[0])}.{name}")
        return self._tables[key]

    def scan(
        self, spark: SparkSession, name: str, namespace: Namespace | None = None, **options: Any
    ) -> DataFrame:
        return scan(spark, self.table(name, namespace), **options)

    def publish(
        self,
        spark: SparkSession,
        name: str,
        namespace: Namespace | None = None,
        view: str | None = None,
        **options: Any,
    ) -> str:
        """Offer one scan to SQL as a temporary view; its name defaults to the table's.

        A table with required filters needs them here, since a view's reader
        cannot be asked for them.
        """
        view = view or name
        self.scan(spark, name, namespace, **options).createOrReplaceTempView(view)
        return view
