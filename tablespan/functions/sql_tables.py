"""Table functions for SQL, whose columns may depend on the arguments.

    fields = RowFunction("fields", [Parameter("text", T.StringType()),
                                    Parameter("wanted", T.StringType(), constant=True)], schema_of, rows_of)
    fields.register(spark)
    spark.sql("SELECT event_id, f.* FROM events, LATERAL fields(props, wanted => 'k bigint') AS f")

A :class:`RowFunction` gives rows for one set of arguments and can be called in FROM or with
LATERAL.  A :class:`StreamFunction` takes a table, dealt by PARTITION BY and
sorted by ORDER BY, and sees one row at a time, so it holds its state and at most an Arrow batch of
a partition's rows.  Where its columns are known before the call, as over a frame or for a table that
it is registered for, whole batches go in and out; Spark calls a function whose columns follow from the
call row by row, with an Arrow batch for each, which takes several times as long.
Prefer Spark's own functions where they will do: these run in Python workers, fed in
Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import chain, islice
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.conversion import ArrowTableToRowsConversion, LocalDataToArrowConversion
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, UserDefinedTableFunction

from tablespan.operators.layout import refuse_uneven

_NO_DEFAULT = object()
MOST_ROWS = 10_000  # that leave a stream as one Arrow table


@dataclass(frozen=True)
class Parameter:
    """An argument of a table function; only constant ones are known when its columns are."""

    name: str
    kind: T.DataType
    constant: bool = False
    default: Any = _NO_DEFAULT

    @property
    def required(self) -> bool:
        return self.default is _NO_DEFAULT


def _bound(function: str, parameters: Sequence[Parameter], given: Sequence[Any], named: Mapping[str, Any]) -> dict[str, Any]:
    """What was given for each parameter by place or by name; SQL itself refuses a name that is given twice."""
    names = {p.name.lower(): p.name for p in parameters}
    if len(given) > len(parameters):
        raise TypeError(f"{function} takes {len(parameters)} argument(s), got {len(given)}")
    found = dict(zip((p.name for p in parameters), given))
    for name, value in named.items():
        if name.lower() not in names:
            raise TypeError(f"{function} has no argument '{name}'")
        if names[name.lower()] in found:
            raise TypeError(f"{function}: argument '{name}' is given twice")
        found[names[name.lower()]] = value
    missing = [p.name for p in parameters if p.required and p.name not in found]
    if missing:
        raise TypeError(f"{function} lacks argument(s) {missing}")
    return found


def _fits(given: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(given, T.NullType) or given == wanted:
        return True
    if isinstance(wanted, (T.FloatType, T.DoubleType)):
        return isinstance(given, T.NumericType)
    return isinstance(wanted, T.LongType) and isinstance(given, T.IntegralType)


def _constants(function: str, parameters: Sequence[Parameter], found: Mapping[str, AnalyzeArgument]) -> dict[str, Any]:
    """The values of constant parameters; all types are checked."""
    values = {}
    for p in parameters:
        argument = found.get(p.name)
        if argument is None:
            values[p.name] = p.default
            continue
        if argument.isTable or not _fits(argument.dataType, p.kind):
            shown = "a table" if argument.isTable else argument.dataType.simpleString()
            raise TypeError(f"{function}: argument '{p.name}' must be a {p.kind.simpleString()}, got {shown}")
        if p.constant:
            if not argument.isConstantExpression:
                raise TypeError(f"{function}: argument '{p.name}' must be a constant")
            values[p.name] = argument.value
    return {p.name: values[p.name] for p in parameters if p.constant and p.name in values}


def _filled(parameters: Sequence[Parameter], found: Mapping[str, Any]) -> dict[str, Any]:
    """Values as the declared types have them, such as whole decimals as floats."""
    made = {}
    for p in parameters:
        value = found.get(p.name, p.default)
        made[p.name] = float(value) if value is not None and isinstance(p.kind, (T.FloatType, T.DoubleType)) else value
    return made


@dataclass(frozen=True)
class RowFunction:
    """Rows from arguments; ``schema`` gets the constant ones by name, ``rows`` gets all."""

    name: str
    parameters: Sequence[Parameter]
    schema: Callable[..., T.StructType]
    rows: Callable[..., Iterable[tuple]]
    deterministic: bool = True

    def register(self, spark: SparkSession) -> UserDefinedTableFunction:
        """Make the function known to SQL under its name."""
        name, parameters, schema, rows = self.name, tuple(self.parameters), self.schema, self.rows

        class Handler:
            @staticmethod
            def analyze(*given: AnalyzeArgument, **named: AnalyzeArgument) -> AnalyzeResult:
                found = _bound(name, parameters, given, named)
                return AnalyzeResult(schema(**_constants(name, parameters, found)))

            def eval(self, *given: Any, **named: Any) -> Iterator[tuple]:
                yield from rows(**_filled(parameters, _bound(name, parameters, given, named)))

        return _registered(spark, name, F.udtf(Handler, useArrow=True), self.deterministic)


@dataclass(frozen=True)
class StreamFunction:
    """Rows from a table's rows, in their order within each partition.

    ``schema`` gets the table's own schema and the constant arguments.  ``begin`` makes the state of
    a partition from the arguments, ``step`` takes the state and a row and gives the rows that are
    ready, and ``end`` gives the last ones.  All other parameters are constant.
    """

    name: str
    parameters: Sequence[Parameter]
    schema: Callable[..., T.StructType]
    begin: Callable[..., Any]
    step: Callable[[Any, Row], Iterable[tuple]]
    end: Callable[[Any], Iterable[tuple]]
    deterministic: bool = True

    def register(self, spark: SparkSession, table: T.StructType | None = None, **arguments: Any) -> UserDefinedTableFunction:
        """Make the function known to SQL: name(TABLE(t) PARTITION BY k ORDER BY o, argument => value).

        With the schema of a `table` the columns are those for it and the given arguments, and rows go in
        and out in batches; a call with another table's columns or other arguments then fails.
        """
        if table is not None:
            fixed = _filled(self.parameters, _bound(self.name, self.parameters, (), arguments))
            return _registered(spark, self.name, self._in_batches(table, self.schema(table, **fixed), fixed), self.deterministic)
        name, parameters = self.name, tuple(self.parameters)
        schema, begin, step, end = self.schema, self.begin, self.step, self.end

        class Handler:
            def __init__(self) -> None:
                self.state: Any = None
                self.open = False

            @staticmethod
            def analyze(table: AnalyzeArgument, *given: AnalyzeArgument, **named: AnalyzeArgument) -> AnalyzeResult:
                if not table.isTable:
                    raise TypeError(f"{name}: the first argument must be a TABLE")
                constants = _constants(name, parameters, _bound(name, parameters, given, named))
                return AnalyzeResult(schema(table.dataType, **constants))

            def eval(self, table: Row, *given: Any, **named: Any) -> Iterator[tuple]:
                if not self.open:
                    self.state = begin(**_filled(parameters, _bound(name, parameters, given, named)))
                    self.open = True
                yield from step(self.state, table)

            def terminate(self) -> Iterator[tuple]:
                if self.open:
                    yield from end(self.state)

        return _registered(spark, name, F.udtf(Handler, useArrow=True), self.deterministic)

    def _in_batches(self, table: T.StructType, columns: T.StructType, fixed: Mapping[str, Any] | None = None) -> UserDefinedTableFunction:
        """The function for tables of one schema and with these columns; `fixed` are the arguments it takes, if not any."""
        name, parameters = self.name, tuple(self.parameters)
        begin, step, end = self.begin, self.step, self.end

        class Handler:
            def __init__(self) -> None:
                self.state: Any = None
                self.open = False

            def eval(self, rows: pa.RecordBatch, *given: pa.Array, **named: pa.Array) -> Iterator[pa.Table]:
                if not self.open:
                    _same_columns(name, table, rows.schema)
                    found = _filled(parameters, _bound(name, parameters, [_one(x) for x in given], {n: _one(x) for n, x in named.items()}))
                    if fixed is not None and found != fixed:
                        raise ValueError(f"{name} is registered for the arguments {fixed}, got {found}")
                    self.state = begin(**found)
                    self.open = True
                held = ArrowTableToRowsConversion.convert(pa.Table.from_batches([rows]), table)
                yield from _tables(chain.from_iterable(step(self.state, row) for row in held), columns)

            def terminate(self) -> Iterator[pa.Table]:
                if self.open:
                    yield from _tables(end(self.state), columns)

        return F.arrow_udtf(Handler, returnType=columns)

    def over(
        self,
        frame: DataFrame,
        keys: Sequence[str],
        order: Sequence[str | Column],
        most_share: float | None = None,
        **arguments: Any,
    ) -> DataFrame:
        """The function over a frame: one partition for each key, whose rows stream through one task.

        ``most_share`` is the largest share of rows that a key may hold; the share is measured, and a
        larger one is refused, since only a function that can work on parts of a key could be spread.
        """
        refuse_uneven(frame, keys, most_share)
        if not keys:
            raise ValueError(f"{self.name}: a stream needs at least one key; a table without one is a single task")
        table = frame.asTable().partitionBy(*keys)
        if order:
            table = table.orderBy(*order)
        given = {n: F.lit(v) for n, v in arguments.items()}
        columns = self.register(frame.sparkSession)(table, **given).schema  # Spark checks the call and its arguments
        made = self._in_batches(frame.schema, columns)
        return (made.asDeterministic() if self.deterministic else made)(table, **given)


def _same_columns(function: str, table: T.StructType, given: pa.Schema) -> None:
    """Raise unless a batch has a table's names, and its timestamps their kind; other types fail where they are used."""
    clocks = [pa.types.is_timestamp(f.type) and f.type.tz is not None for f in given]
    if given.names != table.names or clocks != [isinstance(f.dataType, T.TimestampType) for f in table]:
        raise TypeError(f"{function} is registered for {table.simpleString()}, got {given.names}")


def _one(values: pa.Array) -> Any:
    """The value that all of an argument's values are."""
    if len(found := values.unique()) != 1:
        raise TypeError("the arguments of a stream must be constants")
    return found[0].as_py()


def _tables(rows: Iterable[tuple], columns: T.StructType) -> Iterator[pa.Table]:
    left = iter(rows)
    while made := list(islice(left, MOST_ROWS)):
        yield LocalDataToArrowConversion.convert(made, columns, False)


def _registered(spark: SparkSession, name: str, made: UserDefinedTableFunction, deterministic: bool) -> UserDefinedTableFunction:
    if deterministic:
        made = made.asDeterministic()
    spark.udtf.register(name, made)
    return made
