"""Rules every function call obeys: NULL arguments and session settings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_strict(arguments: Sequence[Column], value: Column) -> Column:
    """NULL as soon as any argument is NULL, without evaluating ``value`` for that row."""
    if not arguments:
        return value
    any_null = reduce(Column.__or__, (a.isNull() for a in arguments))
    return F.when(~any_null, value)


@dataclass(frozen=True)
class Setting:
    """A session setting a function reads: its name, Spark type and fallback."""

    name: str
    kind: T.DataType
    default: Any = None


# The setting types that can be written as session text.
_READERS = {
    T.BooleanType: lambda text: text.strip().lower() == "true",
    T.ByteType: int,
    T.ShortType: int,
    T.IntegerType: int,
    T.LongType: int,
    T.FloatType: float,
    T.DoubleType: float,
    T.StringType: str,
}


def setting_value(spark: SparkSession, setting: Setting) -> Column:
    """The setting as a typed literal, read from the session now.

    An unset setting, and one of a type that has no text form, gives the
    function's own default.
    """
    text = spark.conf.get(setting.name, None)
    reader = _READERS.get(type(setting.kind))
    value = setting.default if text is None or reader is None else reader(text)
    return F.lit(value).cast(setting.kind)
