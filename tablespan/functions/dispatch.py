"""Choose an overload of a function by the types of the arguments at the call.

    describe = Function("describe", [
        Overload([T.IntegerType()], lambda c: ...),
        Overload([T.StringType()], lambda c: ...),
    ])
    df.select("*", describe.on(df, "amount").alias("what"))

Types are read from the DataFrame's schema on the driver; the chosen builder
returns an ordinary column expression.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.functions.contract import null_strict

ANY = "any"


class DispatchError(TypeError):
    """No overload, or more than one, fits a call."""


@dataclass(frozen=True)
class Overload:
    """One way to call a function.

    ``parameters`` are Spark types or ``ANY``.  With ``varargs`` the last one may
    be given any number of times, each time with its own type.  ``unsigned``
    marks a variant written for unsigned integers, which Spark reads as signed
    ones.  ``special_nulls`` lets NULL arguments reach ``build``.  A variant that may
    give another value for equal arguments says ``deterministic=False``: Spark then makes
    its value once for a row, where the call stands, and neither repeats nor moves it.
    """

    parameters: Sequence[T.DataType | str]
    build: Callable[..., Column]
    varargs: bool = False
    unsigned: bool = False
    special_nulls: bool = False
    deterministic: bool = True

    def __post_init__(self) -> None:
        if self.varargs and not self.parameters:
            raise ValueError("varargs need a parameter to repeat")
        for parameter in self.parameters:
            if parameter != ANY and not isinstance(parameter, T.DataType):
                raise TypeError(f"parameter {parameter!r} is neither a Spark type nor 'any'")
            if isinstance(parameter, T.DataType):
                _refuse_map(parameter)

    @property
    def fixed(self) -> int:
        return len(self.parameters) - 1 if self.varargs else len(self.parameters)

    def takes(self, count: int) -> bool:
        return count >= self.fixed if self.varargs else count == self.fixed

    def fits(self, types: Sequence[T.DataType], widening: bool) -> bool:
        """Whether the fixed parameters accept these types; the repeated tail has no say."""
        return all(
            parameter == ANY
            or isinstance(given, T.NullType)
            or _bare(given) == _bare(parameter)
            or (widening and _widens(given, parameter))
            for parameter, given in zip(self.parameters[: self.fixed], types)
        )


# Signed integers from narrow to wide.
_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def _widens(given: T.DataType, parameter: T.DataType) -> bool:
    if isinstance(given, T.DecimalType):
        return isinstance(parameter, (T.FloatType, T.DoubleType))
    if given in _INTEGERS and parameter in _INTEGERS:
        return _INTEGERS.index(given) <= _INTEGERS.index(parameter)
    return False


def _bare(kind: T.DataType) -> T.DataType:
    """The type with every part nullable: what may be NULL does not choose an overload."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_bare(kind.elementType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _bare(f.dataType), True) for f in kind.fields])
    return kind


def _refuse_map(kind: T.DataType) -> None:
    if isinstance(kind, T.MapType):
        raise DispatchError("map arguments are not supported")
    if isinstance(kind, T.ArrayType):
        _refuse_map(kind.elementType)
    if isinstance(kind, T.StructType):
        for child in kind.fields:
            _refuse_map(child.dataType)


@dataclass(frozen=True)
class Function:
    name: str
    overloads: Sequence[Overload]

    def choose(self, types: Sequence[T.DataType]) -> Overload:
        """The one overload for these argument types.

        Exact types come first; widening counts only when nothing fits exactly.
        Among several, a single one not written for unsigned integers wins.
        """
        counted = [o for o in self.overloads if o.takes(len(types))]
        if not counted:
            raise DispatchError(f"{self.name} does not take {len(types)} argument(s)")
        fitting = [o for o in counted if o.fits(types, widening=False)]
        fitting = fitting or [o for o in counted if o.fits(types, widening=True)]
        if not fitting:
            shown = ", ".join(t.simpleString() for t in types)
            raise DispatchError(f"{self.name} has no variant for ({shown})")
        if len(fitting) > 1:
            signed = [o for o in fitting if not o.unsigned]
            if len(signed) != 1:
                shown = ", ".join(t.simpleString() for t in types)
                raise DispatchError(f"{self.name}({shown}) is ambiguous")
            fitting = signed
        return fitting[0]

    def on(self, frame: DataFrame, *arguments: Any) -> Column:
        """The call as a column of ``frame``.

        An argument is a column, a column name, or any other Python value, which
        is taken as a constant.  Constants may just as well vary by row.
        """
        columns = [_as_column(a) for a in arguments]
        named = [c.alias(f"argument_{i}") for i, c in enumerate(columns)]
        types = [f.dataType for f in frame.select(*named).schema.fields] if named else []
        for kind in types:
            _refuse_map(kind)
        chosen = self.choose(types)
        parameters = _parameters(chosen, len(types))
        typed = [_typed(c, t, p) for c, t, p in zip(columns, types, parameters)]
        value = chosen.build(*typed)
        value = value if chosen.special_nulls else null_strict(typed, value)
        # A row's number is never below 0; beside it the whole value counts as not deterministic.
        return value if chosen.deterministic else F.when(F.monotonically_increasing_id() >= 0, value)


def constant(value: Any) -> Column:
    """A text constant; a plain ``str`` argument would name a column."""
    return F.lit(value)


def _as_column(argument: Any) -> Column:
    if isinstance(argument, Column):
        return argument
    return F.col(argument) if isinstance(argument, str) else F.lit(argument)


def _parameters(overload: Overload, count: int) -> list[T.DataType | str]:
    fixed = list(overload.parameters[: overload.fixed])
    return fixed + [ANY] * (count - len(fixed))


def _typed(column: Column, given: T.DataType, parameter: T.DataType | str) -> Column:
    """A bare NULL becomes the parameter's type, or ``bigint`` where any type goes."""
    if isinstance(given, T.NullType):
        return column.cast(T.LongType() if parameter == ANY else parameter)
    return column if parameter == ANY or given == parameter else column.cast(_bare(parameter))
