"""User-defined aggregates with a mergeable state.

Prefer a native aggregate wherever one exists; this is for functions Spark
lacks.  A group is represented by a small state, never by its rows:

1. each task folds its own rows into one state per group it meets,
2. states of a group are combined and the result is computed.

Large states can be combined in several shares first, at the cost of a shuffle.

So a group that holds a third of all rows is folded where its rows are, and no
task sees more than states.  Every step works on whole Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pandas.api.typing import DataFrameGroupBy
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.arrow_types import arrow_field
from tablespan.operators.schema import quoted


class Aggregate(Protocol):
    """A user-defined aggregate over pandas frames.

    ``state`` is the DDL of the state's fields, ``result`` the DDL of the result
    type.  Combining must not depend on order or grouping, and ``empty`` must be
    neutral in it.
    """

    state: str
    result: str

    def start(self, rows: pd.DataFrame) -> pd.DataFrame:
        """One state per row; NULL arguments are passed in like any other."""

    def combine(self, groups: DataFrameGroupBy) -> pd.DataFrame:
        """One state per group."""

    def finish(self, states: pd.DataFrame) -> pd.Series:
        """One result per state."""

    def empty(self) -> tuple[Any, ...]:
        """The state of no rows at all."""


# How many rows, and bytes, are worked on at once, and how many states
# a task holds before it passes them on.
ROWS_AT_ONCE = 100_000
BYTES_AT_ONCE = 32 << 20
STATES_PER_TASK = 100_000

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def user_aggregate(
    frame: DataFrame,
    keys: Sequence[str],
    function: Aggregate,
    arguments: Sequence[str] = (),
    result: str = "result",
    shares: int = 1,
) -> DataFrame:
    """One row per group: the keys and the function's result.

    Without keys there is exactly one row, also over no rows at all, where the
    result comes from ``empty``.  With keys an empty input has no groups.  Keys
    group as in Spark: 0.0 with -0.0, NaN with NaN, NULL with NULL.  ``shares``
    above one spreads the states of a group over that many tasks before the last.
    """
    named = [_key(frame, k).alias(f"key_{i}") for i, k in enumerate(keys)]
    key_fields = frame.select(*(named or [F.lit(0).alias("key_0")])).schema.fields
    for field, key in zip(key_fields, keys):
        if isinstance(field.dataType, _NESTED):
            raise TypeError(f"column '{key}': a nested column cannot be a grouping key")
    key_names = [f.name for f in key_fields]
    state = T.StructType.fromDDL(function.state)
    held = _all_nullable([*key_fields, *state.fields])
    held_arrow = _arrow(held)

    def combined(states: pd.DataFrame) -> pd.DataFrame:
        groups = states.groupby(key_names, sort=False, dropna=False)
        return function.combine(groups).reset_index()

    def fold(batches: Iterator[pa.RecordBatch], prepare: Callable) -> Iterator[pa.RecordBatch]:
        parts: list[pd.DataFrame] = []
        waiting = 0
        for batch in _gathered(batches):
            parts.append(combined(prepare(batch)))
            waiting += len(parts[-1])
            if waiting < STATES_PER_TASK:
                continue
            parts = [together(parts)]
            waiting = len(parts[0])
            if waiting >= STATES_PER_TASK // 2:
                yield _record(parts[0], held_arrow)
                parts, waiting = [], 0
        if parts:
            yield _record(together(parts), held_arrow)

    def together(parts: list[pd.DataFrame]) -> pd.DataFrame:
        return parts[0] if len(parts) == 1 else combined(pd.concat(parts, ignore_index=True))

    def first_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def prepare(batch: pa.Table) -> pd.DataFrame:
            rows = _frame(batch)
            states = function.start(rows[[f"{_ARGUMENT}{a}" for a in arguments]].set_axis(
                list(arguments), axis=1
            ))
            return pd.concat([rows[key_names], states[state.fieldNames()]], axis=1)

        return fold(batches, prepare)

    def share_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fold(batches, lambda batch: _frame(batch)[held.fieldNames()])

    answer = T.StructField("result", T.StructType.fromDDL(f"r {function.result}")["r"].dataType)
    finished = _all_nullable([*key_fields, answer])
    finished_arrow = _arrow(finished)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answered(states: pd.DataFrame) -> pa.RecordBatch:
            values = function.finish(states[state.fieldNames()])
            return _record(states[key_names].assign(result=values), finished_arrow)

        # Sorted by key: only the last group of a batch can go on in the next one.
        open_group: pd.DataFrame | None = None
        for batch in _gathered(batches):
            states = _frame(batch)
            if open_group is not None:
                states = pd.concat([open_group, states], ignore_index=True)
            groups = combined(states)
            if len(groups) > 1:
                yield answered(groups.iloc[:-1])
            open_group = groups.iloc[-1:]
        if open_group is not None:
            yield answered(open_group)

    given = [F.col(quoted(a)).alias(f"{_ARGUMENT}{a}") for a in arguments]
    rows = frame.select(*(named or [F.lit(0).alias("key_0")]), *given)
    states = rows.mapInArrow(first_states, held)
    shared = states
    if shares > 1:
        spread = states.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(shares)))
        shared = spread.repartition(*key_names, "share").mapInArrow(share_states, held)
    if not keys:
        neutral = frame.sparkSession.createDataFrame([(0, *function.empty())], held)
        shared = shared.union(neutral)
    gathered = shared.repartition(*key_names).sortWithinPartitions(*key_names)
    final = gathered.mapInArrow(results, finished)
    return final.select(
        *[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)], F.col("result").alias(result)
    )


_ARGUMENT = "argument_"


def _key(frame: DataFrame, name: str) -> Column:
    key = F.col(quoted(name))
    if isinstance(frame.schema[name].dataType, (T.FloatType, T.DoubleType)):
        kind = frame.schema[name].dataType
        return F.when(F.isnan(key), F.lit(float("nan")).cast(kind)).otherwise((key + F.lit(0.0).cast(kind)).cast(kind))
    return key


def _all_nullable(fields: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([arrow_field(f.name, f.dataType, f.nullable) for f in schema.fields])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in fewer and larger pieces, as pandas has a fixed cost per piece; none is empty."""
    waiting: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows >= ROWS_AT_ONCE or rows and size >= BYTES_AT_ONCE:
            yield pa.Table.from_batches(waiting)
            waiting, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(waiting)


def _frame(batch: pa.Table) -> pd.DataFrame:
    return batch.to_pandas(types_mapper=pd.ArrowDtype)


def _record(frame: pd.DataFrame, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(frame[schema.names], schema=schema, preserve_index=False)
