"""A branch is one source of a table; the table's rows are the union of its branches.

Every constructor checks its arguments on the driver and returns a
:class:`Branch`, whose ``read`` builds a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablespan.plans.predicates import Bounds, ColumnPath, Predicate
from tablespan.sources.delimited import TextOptions, read_delimited


@dataclass(frozen=True)
class Branch:
    """One source.

    ``read`` gets the session and the table's declared schema (``None`` when the
    source brings its own).  ``filter`` is SQL text over the table's columns,
    applied to this branch alone.  ``bounds`` lets a scan skip the branch.
    Branches with equal ``source`` read the same rows and are read together.  A source
    that can leave rows out for a scan's predicates has a ``plan``, which gets the session and
    them.  Parquet folders under one ``root`` are one read when a scan needs several.
    """

    label: str
    read: Callable[[SparkSession, T.StructType | None], DataFrame]
    filter: str | None = None
    source: tuple | None = None
    bounds: Mapping[ColumnPath, Bounds] = field(default_factory=dict)
    plan: Callable[[SparkSession, Sequence[Predicate]], DataFrame] | None = None
    root: str | None = None

    def filtered(self, condition: str) -> Branch:
        return replace(self, filter=condition)

    def bounded(self, bounds: Mapping[ColumnPath, Bounds]) -> Branch:
        return replace(self, bounds=dict(bounds))


def _paths(function: str, arguments: Sequence[Any], lists: bool) -> list[str]:
    if not arguments:
        raise ValueError(f"{function}: no path was given")
    first = arguments[0]
    if isinstance(first, str):
        return [first]
    if not lists or not isinstance(first, (list, tuple)):
        wanted = "a path or a list of paths" if lists else "one table location"
        raise ValueError(f"{function}: expected {wanted}, got {type(first).__name__}")
    if not first:
        raise ValueError(f"{function}: the path list is empty")
    for item in first:
        if item is None:
            raise ValueError(f"{function}: a path in the list is null")
        if not isinstance(item, str):
            raise ValueError(f"{function}: path list entry {item!r} is not a string")
    return list(first)


def _read_iceberg(location: str, snapshot_id: Any):
    def read(spark: SparkSession, _schema: T.StructType | None) -> DataFrame:
        reader = spark.read.format("iceberg")
        if snapshot_id is not None:
            reader = reader.option("snapshot-id", str(snapshot_id))
        try:
            return reader.load(location)
        except Exception as problem:
            if "DATA_SOURCE_NOT_FOUND" in str(problem):
                raise RuntimeError(
                    f"iceberg_scan of {location} needs the Iceberg Spark runtime jar on this "
                    "cluster's class path"
                ) from problem
            raise

    return read


def scan_function(function: str, *arguments: Any, **named: Any) -> Branch:
    """A source Spark reads by itself: ``read_parquet``, ``read_csv`` or ``iceberg_scan``.

    The file readers take one path or glob, or a non-empty list of them, and no
    named arguments.  ``iceberg_scan`` takes one location and ``snapshot_from_id``.
    """
    name = function.lower()
    known = {"read_parquet": set(), "read_csv": set(), "iceberg_scan": {"snapshot_from_id"}}
    if name not in known:
        raise ValueError(f"unknown scan function '{function}'; known: {sorted(known)}")
    surplus = set(named) - known[name]
    if surplus:
        raise ValueError(f"{function}: unknown named arguments {sorted(surplus)}")
    paths = _paths(function, arguments, lists=name != "iceberg_scan")
    if name == "read_parquet":
        read = lambda spark, _schema: spark.read.parquet(*paths)
    elif name == "read_csv":
        read = lambda spark, _schema: spark.read.csv(paths)
    else:
        read = _read_iceberg(paths[0], named.get("snapshot_from_id"))
    label = f"{name}({paths[0]}{', …' if len(paths) > 1 else ''})"
    return Branch(label, read, source=(name, *paths, *sorted(named.items())))


def partitioned_files(
    spark: SparkSession,
    folder: str,
    bounds: Callable[[dict[str, str | None]], Mapping[ColumnPath, Bounds]],
) -> tuple[Branch, ...]:
    """A branch for each folder of partition values that holds Parquet files.

    ``bounds`` tells from a folder's values what its rows can hold, so a scan reads
    only folders that its predicates may need, and those in one read.  The driver gets file
    names; for very many files, and ranges of columns inside them, see ``manifest``.
    """
    folders = sorted({file.rsplit("/", 1)[0] for file in spark.read.parquet(folder).inputFiles()})
    branches = []
    for place in folders:
        pairs = [part.split("=", 1) for part in place.split("/") if "=" in part]
        values = {unquote(k): None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(unquote(v)) for k, v in pairs}
        branches.append(replace(scan_function("read_parquet", unquote(place)), bounds=dict(bounds(values)), root=folder))
    return tuple(branches)


def together(branches: Sequence[tuple[int, Branch]]) -> list[tuple[int, Branch]]:
    """The numbered branches with all unfiltered folders under one root as a single one, under the first's number."""
    by_root: dict[str, list[tuple[int, Branch]]] = {}
    for number, branch in branches:
        if branch.root is not None and branch.filter is None:
            by_root.setdefault(branch.root, []).append((number, branch))
    grouped = [members for members in by_root.values() if len(members) > 1]
    merged = {number for members in grouped for number, _ in members}
    rest = [(number, branch) for number, branch in branches if number not in merged]
    for members in grouped:
        places = [branch.source[1] for _, branch in members]
        rest.append((members[0][0], scan_function("read_parquet", places)))
    return rest


def format_branch(
    format_name: str, locations: Sequence[str], options: Mapping[str, Any] | None = None
) -> Branch:
    """Text files read against the table's declared schema; only format ``csv`` exists."""
    if format_name.lower() != "csv":
        raise ValueError(f"format '{format_name}' is not readable as a format branch, only csv is")
    parsed = TextOptions.parse(options or {})
    places = list(locations)

    def read(spark: SparkSession, schema: T.StructType | None) -> DataFrame:
        if schema is None:
            raise ValueError("a csv format branch needs the table's declared schema")
        return read_delimited(spark, places, schema, parsed)

    return Branch(f"csv({len(places)} files)", read)


def function_branch(function: Callable[..., DataFrame], *arguments: Any) -> Branch:
    """Rows of a table function: a callable taking the session and the arguments."""
    label = getattr(function, "__name__", "function")
    return Branch(f"{label}{arguments}", lambda spark, _schema: function(spark, *arguments))


def frame_branch(frame: DataFrame, label: str = "frame") -> Branch:
    """Rows of a DataFrame that is at hand already."""
    return Branch(label, lambda _spark, _schema: frame)


def table_branch(name: str) -> Branch:
    """Rows of another table or view of the session."""
    read = lambda spark, _schema: spark.table(name)
    return Branch(f"table({name})", read, source=("table", name))
