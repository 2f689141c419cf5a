"""Functions of one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.functions.contract import null_strict
from tablespan.functions.dispatch import DispatchError

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def sum_values(frame: DataFrame, *columns: Column | str) -> Column:
    """The sum across columns of a row; NULL if any is NULL.

    Integers add up as ``bigint``, decimals by Spark's rules for decimals.
    """
    if not columns:
        raise DispatchError("sum_values needs at least one argument")
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    fields = frame.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).schema.fields
    typed = []
    for value, field in zip(values, fields):
        if isinstance(field.dataType, _INTEGERS + (T.NullType,)):
            value = value.cast("bigint")
        elif not isinstance(field.dataType, T.NumericType):
            raise DispatchError(f"sum_values cannot add a {field.dataType.simpleString()}")
        typed.append(value)
    return null_strict(typed, reduce(Column.__add__, typed))
