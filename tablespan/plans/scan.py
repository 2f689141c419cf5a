"""Scanning a table: check the filters, drop hopeless branches, union the rest, filter, project."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.operators.schema import conform, row_id_schema, show_row_id, union_all
from tablespan.plans.predicates import Predicate, balanced, check_required_filters, conjuncts
from tablespan.plans.tables import Table, VersionedTable
from tablespan.sources.branches import Branch, together


# Fixed value: the column that says which branch a row came from.
BRANCH = "tablespan_branch"


def branch_rows(
    spark: SparkSession,
    table: Table,
    branches: Sequence[tuple[int, Branch]],
    where: Sequence[Predicate] = (),
) -> list[DataFrame]:
    """The rows of numbered branches under the table's schema, with the number as last column.

    Branches over one source share a single read: a row is given out once for
    every branch whose filter it passes, so overlapping filters keep their copies.
    Sources that plan their reads may leave out rows that fail ``where``.
    """
    shared: dict[object, list[tuple[int, Branch]]] = {}
    for number, branch in branches:
        key = number if branch.source is None else branch.source
        shared.setdefault(key, []).append((number, branch))
    return [_read_together(spark, table, members, where) for members in shared.values()]


def _read_together(
    spark: SparkSession, table: Table, members: list[tuple[int, Branch]], where: Sequence[Predicate]
) -> DataFrame:
    number, first = members[0]
    rows = first.plan(spark, where) if first.plan else first.read(spark, table.schema)
    if table.schema is not None:
        rows = conform(rows, table.schema, f"table '{table.name}', {first.label}")
    rows = show_row_id(rows)
    filters = [F.expr(b.filter) if b.filter else F.lit(True) for _, b in members]
    if all(b.filter for _, b in members):
        rows = rows.where(balanced(Column.__or__, filters))
    if len(members) == 1:
        return rows.withColumn(BRANCH, F.lit(number))
    if table.exclusive:
        taker = F.when(filters[0], F.lit(number))
        for condition, (n, _) in zip(filters[1:], members[1:]):
            taker = taker.when(condition, F.lit(n))
        return rows.withColumn(BRANCH, taker).where(F.col(BRANCH).isNotNull())
    # The misses go before the explode, so a row is copied for its branches only.
    takers = [F.when(f, F.lit(n)) for f, (n, _) in zip(filters, members)]
    return rows.select("*", F.explode(F.array_compact(F.array(*takers))).alias(BRANCH))


def kept_branches(table: Table, where: Sequence[Predicate]) -> list[tuple[int, Branch]]:
    """The branches, with their numbers, whose known value ranges can satisfy every predicate."""
    return [
        (number, branch)
        for number, branch in enumerate(table.branches)
        if all(p.may_hold(dict(branch.bounds)) for p in where)
    ]


def scan(
    spark: SparkSession,
    table: Table | VersionedTable,
    *,
    where: Predicate | Sequence[Predicate] = (),
    columns: Sequence[str] = (),
    version: str | None = None,
    as_of: dt.datetime | None = None,
    acknowledge_required_filters: bool = False,
) -> DataFrame:
    """A lazy DataFrame of the table's rows.

    The union keeps duplicates and promises no order.  ``where`` is evaluated on
    every row; it also satisfies required filters and lets branches with known
    bounds be skipped.  No ``columns`` means all of them.  Acknowledging the
    required filters skips their check.
    """
    if isinstance(table, VersionedTable):
        table = table.pick(version, as_of)
    elif version is not None or as_of is not None:
        raise ValueError(f"table '{table.name}' has no history")
    conditions = conjuncts(where)
    if not acknowledge_required_filters:
        check_required_filters(table.name, table.required_filters, conditions)
    kept = kept_branches(table, conditions)
    if not kept and table.schema is None:
        kept = [(0, table.branches[0])]
    if kept:
        rows = union_all(branch_rows(spark, table, together(kept), conditions)).drop(BRANCH)
    else:
        rows = spark.createDataFrame([], row_id_schema(table.schema))
    for condition in conditions:
        rows = rows.where(condition.column(rows.schema))
    return rows.select(*columns) if columns else rows
