"""Table functions: arguments in, a lazy DataFrame out.

The schema of the result may depend on the argument values.  Nothing is run or
brought to the driver by a call.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The argument types a table function takes.
_PYTHON_TYPES: dict[type[T.DataType], tuple[type, ...]] = {
    T.BooleanType: (bool,),
    T.ByteType: (int,),
    T.ShortType: (int,),
    T.IntegerType: (int,),
    T.LongType: (int,),
    T.FloatType: (float, int),
    T.DoubleType: (float, int),
    T.StringType: (str,),
    T.BinaryType: (bytes, bytearray),
}


@dataclass(frozen=True)
class TableFunction:
    """A named builder of DataFrames; ``parameters`` are (name, Spark type) in order."""

    name: str
    parameters: Sequence[tuple[str, T.DataType]]
    build: Callable[..., DataFrame]

    def __post_init__(self) -> None:
        for name, kind in self.parameters:
            if type(kind) not in _PYTHON_TYPES:
                raise TypeError(
                    f"{self.name}: parameter '{name}' cannot be a {kind.simpleString()}"
                )

    def call(self, spark: SparkSession, *arguments: Any) -> DataFrame:
        """Check the arguments against the declared parameters and build the result."""
        if len(arguments) != len(self.parameters):
            raise TypeError(
                f"{self.name} takes {len(self.parameters)} argument(s), got {len(arguments)}"
            )
        for (name, kind), value in zip(self.parameters, arguments):
            allowed = _PYTHON_TYPES[type(kind)]
            wrong_bool = isinstance(value, bool) and bool not in allowed
            if value is not None and (wrong_bool or not isinstance(value, allowed)):
                raise TypeError(
                    f"{self.name}: argument '{name}' must be a {kind.simpleString()}, got {value!r}"
                )
        return self.build(spark, *arguments)

