"""Predicates that can be inspected before they become Spark columns.

A ``Column`` cannot be looked into from Python, so a scan that must refuse
missing filters, or skip sources by their value ranges, takes these instead:

    at("bbox", "xmin") >= 3          # a path into a struct column
    at("n").is_null()
    (at("n") < 1) | (at("n") > 9)    # one column: counts as a filter on n
    at("n").isin(1, 2)               # evaluated, but does not count as a filter on n
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.schema import quoted

ColumnPath = tuple[str, ...]


@dataclass(frozen=True)
class Bounds:
    """What is known about one column of one source; ``None`` means unknown."""

    low: Any = None
    high: Any = None
    nulls: int | None = None
    rows: int | None = None


class Predicate:
    """A condition over a table's columns."""

    def column(self, schema: T.StructType) -> Column:
        """The condition as a Spark column over a table with this schema."""
        raise NotImplementedError

    def path(self) -> ColumnPath | None:
        """The single column path this condition filters on, if it counts as such a filter."""
        return None

    def may_hold(self, bounds: dict[ColumnPath, Bounds]) -> bool:
        """False only when no row of a source with these bounds can satisfy the condition."""
        return True

    def __and__(self, other: Predicate) -> Predicate:
        return All((self, other))

    def __or__(self, other: Predicate) -> Predicate:
        return AnyOf((self, other))

    def __invert__(self) -> Predicate:
        return Not(self)


def _type_at(schema: T.StructType, path: ColumnPath) -> T.DataType | None:
    current: T.DataType = schema
    for name in path:
        if not isinstance(current, T.StructType) or name not in current.fieldNames():
            return None
        current = current[name].dataType
    return current


def _column_at(path: ColumnPath) -> Column:
    return F.col(".".join(quoted(part) for part in path))


def _literal(value: Any, kind: T.DataType | None) -> Column:
    # A naive datetime literal is zoned by default; against a zone-less column
    # that would compare through the session zone and never reach the file scan.
    if isinstance(value, dt.datetime) and isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value)


# The comparison operators a scan filter can be made of.
_OPERATORS = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


@dataclass(frozen=True)
class Compare(Predicate):
    """``path operator value``; a NULL value makes it never true and no filter."""

    on: ColumnPath
    operator: str
    value: Any

    def column(self, schema: T.StructType) -> Column:
        literal = _literal(self.value, _type_at(schema, self.on))
        return _OPERATORS[self.operator](_column_at(self.on), literal)

    def path(self) -> ColumnPath | None:
        return None if self.value is None else self.on

    def may_hold(self, bounds: dict[ColumnPath, Bounds]) -> bool:
        if self.value is None:
            return False
        known = bounds.get(self.on)
        if known is None:
            return True
        if known.rows is not None and known.nulls == known.rows:
            return False
        low, high = known.low, known.high
        if not (_orders_alike(low, self.value) and _orders_alike(high, self.value)):
            return True
        if self.operator == "=":
            return low <= self.value <= high
        if self.operator == "<>":
            return not (low == self.value == high)
        edge = high if self.operator in (">", ">=") else low
        return _OPERATORS[self.operator](edge, self.value)


def balanced(
    join: Callable[[Column, Column], Column], parts: Sequence[Column]
) -> Column:
    """All parts joined pair by pair, so that the expression's depth grows with their logarithm."""
    level = list(parts)
    while len(level) > 1:
        level = [join(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _orders_alike(bound: Any, value: Any) -> bool:
    """Whether Python orders the two as Spark does; otherwise Spark decides row by row."""
    if any(isinstance(v, float) and math.isnan(v) for v in (bound, value)):
        return False
    if isinstance(bound, dt.datetime) and isinstance(value, dt.datetime):
        if (bound.tzinfo is None) != (value.tzinfo is None):  # Python cannot order the two
            return False
    kinds = {type(bound), type(value)}
    if kinds == {int, float}:  # Spark compares these as doubles
        return all(abs(v) <= 2**53 for v in (bound, value))
    return len(kinds) == 1 and type(bound) in _ORDERED


_ORDERED = (int, float, str, dt.date, dt.datetime, Decimal)


@dataclass(frozen=True)
class NullTest(Predicate):
    on: ColumnPath
    null: bool

    def column(self, schema: T.StructType) -> Column:
        target = _column_at(self.on)
        return target.isNull() if self.null else target.isNotNull()

    def path(self) -> ColumnPath | None:
        return self.on

    def may_hold(self, bounds: dict[ColumnPath, Bounds]) -> bool:
        known = bounds.get(self.on)
        if known is None or known.nulls is None:
            return True
        if self.null:
            return known.nulls > 0
        return known.rows is None or known.nulls < known.rows


@dataclass(frozen=True)
class All(Predicate):
    parts: tuple[Predicate, ...]

    def column(self, schema: T.StructType) -> Column:
        return balanced(Column.__and__, [p.column(schema) for p in self.parts])

    def path(self) -> ColumnPath | None:
        return _shared_path(self.parts)

    def may_hold(self, bounds: dict[ColumnPath, Bounds]) -> bool:
        return all(p.may_hold(bounds) for p in self.parts)


@dataclass(frozen=True)
class AnyOf(Predicate):
    parts: tuple[Predicate, ...]

    def column(self, schema: T.StructType) -> Column:
        return balanced(Column.__or__, [p.column(schema) for p in self.parts])

    def path(self) -> ColumnPath | None:
        return _shared_path(self.parts)

    def may_hold(self, bounds: dict[ColumnPath, Bounds]) -> bool:
        return any(p.may_hold(bounds) for p in self.parts)


def _shared_path(parts: tuple[Predicate, ...]) -> ColumnPath | None:
    paths = {p.path() for p in parts}
    return paths.pop() if len(paths) == 1 else None


@dataclass(frozen=True)
class Not(Predicate):
    inner: Predicate

    def column(self, schema: T.StructType) -> Column:
        return ~self.inner.column(schema)


@dataclass(frozen=True)
class IsIn(Predicate):
    on: ColumnPath
    values: tuple[Any, ...]

    def column(self, schema: T.StructType) -> Column:
        kind = _type_at(schema, self.on)
        return _column_at(self.on).isin(*[_literal(v, kind) for v in self.values])

    def may_hold(self, bounds: dict[ColumnPath, Bounds]) -> bool:
        return any(Compare(self.on, "=", v).may_hold(bounds) for v in self.values)


@dataclass(frozen=True)
class StartsWith(Predicate):
    on: ColumnPath
    prefix: str

    def column(self, schema: T.StructType) -> Column:
        return _column_at(self.on).startswith(self.prefix)


@dataclass(frozen=True)
class CompareColumns(Predicate):
    left: ColumnPath
    operator: str
    right: ColumnPath

    def column(self, schema: T.StructType) -> Column:
        return _OPERATORS[self.operator](_column_at(self.left), _column_at(self.right))


class At:
    """A column path, ready to be compared."""

    def __init__(self, *path: str):
        if not path:
            raise ValueError("a column path needs at least one name")
        self.path = path

    def _compare(self, operator: str, other: Any) -> Predicate:
        if isinstance(other, At):
            return CompareColumns(self.path, operator, other.path)
        return Compare(self.path, operator, other)

    def __eq__(self, other: Any) -> Predicate:  # type: ignore[override]
        return self._compare("=", other)

    def __ne__(self, other: Any) -> Predicate:  # type: ignore[override]
        return self._compare("<>", other)

    def __gt__(self, other: Any) -> Predicate:
        return self._compare(">", other)

    def __ge__(self, other: Any) -> Predicate:
        return self._compare(">=", other)

    def __lt__(self, other: Any) -> Predicate:
        return self._compare("<", other)

    def __le__(self, other: Any) -> Predicate:
        return self._compare("<=", other)

    __hash__ = None  # type: ignore[assignment]

    def is_null(self) -> Predicate:
        return NullTest(self.path, True)

    def is_not_null(self) -> Predicate:
        return NullTest(self.path, False)

    def isin(self, *values: Any) -> Predicate:
        return IsIn(self.path, values)

    def startswith(self, prefix: str) -> Predicate:
        return StartsWith(self.path, prefix)

    def between(self, low: Any, high: Any) -> Predicate:
        return (self >= low) & (self <= high)


def at(*path: str) -> At:
    return At(*path)


def conjuncts(predicates: Predicate | tuple[Predicate, ...] | list[Predicate]) -> list[Predicate]:
    """The top-level conditions, with every outer AND taken apart."""
    if isinstance(predicates, All):
        return [c for part in predicates.parts for c in conjuncts(part)]
    if isinstance(predicates, Predicate):
        return [predicates]
    return [c for p in predicates for c in conjuncts(p)]


class RequiredFilterError(ValueError):
    """A scan lacks a filter its table insists on."""


def check_required_filters(
    owner: str,
    required: tuple[tuple[ColumnPath, ...], ...],
    predicates: list[Predicate],
) -> None:
    """Refuse unless each group has a path filtered directly or through an enclosing struct."""
    covered = {p.path() for p in predicates} - {None}
    for group in required:
        if not any(path[: len(have)] == have for path in group for have in covered):
            names = " or ".join(".".join(path) for path in group)
            raise RequiredFilterError(f"table '{owner}' needs a filter on {names}")
