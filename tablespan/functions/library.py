"""Functions by namespace and name: typed column functions, aggregates and table functions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

from tablespan.functions.dispatch import Function
from tablespan.functions.table_functions import TableFunction
from tablespan.operators.aggregates import Aggregate, user_aggregate

Namespace = tuple[str, ...]


class UnknownFunctionError(LookupError):
    """No function of this kind has this name."""


class Library:
    """Holds functions; names ignore case, and a name without namespace means the default one.

    The three kinds have names of their own: a column function and a table
    function may be called the same.  An overloaded function is one entry.
    """

    def __init__(self, default_namespace: Namespace = ("main",)):
        self.default_namespace = default_namespace
        self._held: dict[tuple[str, Namespace, str], tuple[str, Any]] = {}

    def add(
        self,
        name: str,
        function: Function | Aggregate | TableFunction,
        namespace: Namespace | None = None,
    ) -> None:
        """Add a function; of several aggregates with one name the first is kept."""
        key = (_kind(function), tuple(namespace or self.default_namespace), name.lower())
        if key in self._held and key[0] != "aggregate":
            raise ValueError(f"{key[0]} function {'.'.join(key[1])}.{name} is defined already")
        self._held.setdefault(key, (name, function))

    def names(self, kind: str, namespace: Namespace | None = None) -> list[str]:
        wanted = tuple(namespace or self.default_namespace)
        return sorted(n for (k, ns, _), (n, _f) in self._held.items() if (k, ns) == (kind, wanted))

    def _find(self, kind: str, name: str, namespace: Namespace | None) -> Any:
        key = (kind, tuple(namespace or self.default_namespace), name.lower())
        if key not in self._held:
            raise UnknownFunctionError(f"no {kind} function {'.'.join(key[1])}.{name}")
        return self._held[key][1]

    def column(self, frame: DataFrame, name: str, *arguments: Any, namespace=None) -> Column:
        """A typed call as a column of ``frame``."""
        return self._find("column", name, namespace).on(frame, *arguments)

    def table(self, spark: SparkSession, name: str, *arguments: Any, namespace=None) -> DataFrame:
        """The lazy result of a table function."""
        return self._find("table", name, namespace).call(spark, *arguments)

    def aggregate(
        self,
        frame: DataFrame,
        keys: Sequence[str],
        name: str,
        arguments: Sequence[str] = (),
        result: str | None = None,
        namespace=None,
    ) -> DataFrame:
        """A user-defined aggregate over groups; the result column is named after it."""
        function = self._find("aggregate", name, namespace)
        return user_aggregate(frame, keys, function, arguments, result or name)


def _kind(function: Any) -> str:
    if isinstance(function, Function):
        return "column"
    return "table" if isinstance(function, TableFunction) else "aggregate"
