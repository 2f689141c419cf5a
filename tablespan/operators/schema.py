"""Make a DataFrame wear a declared schema: positional names, safe widening, row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.arrow_types import ROW_ID_KEY

ROW_ID = "rowid"

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_INTEGER_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
# Parquet readers hand an unsigned 64-bit column over as this type.
_UNSIGNED_LONG = T.DecimalType(20, 0)


def quoted(name: str) -> str:
    """A column name safe for ``F.col`` even when it holds dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def widens(actual: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of ``actual`` is exactly representable in ``declared``."""
    if actual == declared or isinstance(actual, T.NullType):
        return True
    if actual in _INTEGERS:
        if declared in _INTEGERS:
            return _INTEGERS.index(actual) <= _INTEGERS.index(declared)
        if isinstance(declared, T.DecimalType):
            return declared.precision - declared.scale >= _INTEGER_DIGITS[actual]
        return isinstance(declared, T.DoubleType) and not isinstance(actual, T.LongType)
    if isinstance(actual, T.FloatType):
        return isinstance(declared, T.DoubleType)
    if isinstance(actual, T.DecimalType) and isinstance(declared, T.DecimalType):
        return (
            declared.scale >= actual.scale
            and declared.precision - declared.scale >= actual.precision - actual.scale
        )
    if isinstance(actual, T.ArrayType) and isinstance(declared, T.ArrayType):
        return widens(actual.elementType, declared.elementType)
    if isinstance(actual, T.MapType) and isinstance(declared, T.MapType):
        return widens(actual.keyType, declared.keyType) and widens(
            actual.valueType, declared.valueType
        )
    if isinstance(actual, T.StructType) and isinstance(declared, T.StructType):
        return len(actual) == len(declared) and all(
            widens(a.dataType, d.dataType) for a, d in zip(actual.fields, declared.fields)
        )
    return False


def _names_match(actual: T.DataType, declared: T.DataType) -> bool:
    """Types equal up to nullability, so no cast is needed."""
    return actual.simpleString() == declared.simpleString()


def _conformed(column: Column, actual: T.DataType, field: T.StructField, owner: str) -> Column:
    declared = field.dataType
    if _names_match(actual, declared):
        return column
    if actual == _UNSIGNED_LONG and isinstance(declared, T.LongType):
        too_big = F.raise_error(f"{owner}: column '{field.name}' holds a value above 2^63-1")
        return F.when(column > F.lit(2**63 - 1), too_big.cast(declared)).otherwise(
            column.cast(declared)
        )
    if widens(actual, declared):
        return column.cast(declared)
    raise TypeError(
        f"{owner}: column '{field.name}' is {actual.simpleString()} and cannot be read as "
        f"{declared.simpleString()} without loss"
    )


def conform(frame: DataFrame, schema: T.StructType, owner: str = "table") -> DataFrame:
    """Rename and widen ``frame`` column by column, in order, to ``schema``.

    Only projections and casts are added, and none where the types already
    agree, so filters and column pruning still reach the file scan.
    """
    actual = frame.schema.fields
    if len(actual) != len(schema.fields):
        raise ValueError(
            f"{owner}: source has {len(actual)} columns, "
            f"the declared schema has {len(schema.fields)}"
        )
    columns = [
        _conformed(F.col(quoted(a.name)), a.dataType, d, owner).alias(d.name, metadata=d.metadata)
        for a, d in zip(actual, schema.fields)
    ]
    return frame.select(*columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of all frames, by position; paired up so that the plan stays shallow."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_all(frames[:half]).union(union_all(frames[half:]))


def show_row_id(frame: DataFrame) -> DataFrame:
    """Show the column tagged as row id in its field metadata under the name ``rowid``."""
    tagged = [f.name for f in frame.schema.fields if ROW_ID_KEY in f.metadata]
    return frame.withColumnsRenamed({name: ROW_ID for name in tagged})


def row_id_schema(schema: T.StructType) -> T.StructType:
    """The schema :func:`show_row_id` produces."""
    return T.StructType(
        [
            T.StructField(
                ROW_ID if ROW_ID_KEY in f.metadata else f.name, f.dataType, f.nullable, f.metadata
            )
            for f in schema.fields
        ]
    )
