"""Arrow types and schemas expressed as Spark types, and back.

Unsigned integers take the next wider signed Spark type.  UINT64 has no wider
one and becomes ``bigint``; values above 2**63-1 raise when the data is
conformed (see :mod:`tablespan.operators.schema`) rather than turning negative.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import types as T

ROW_ID_KEY = "is_row_id"

# Which Spark type stands for which Arrow type.
_SIMPLE = {
    pa.bool_(): T.BooleanType(),
    pa.int8(): T.ByteType(),
    pa.int16(): T.ShortType(),
    pa.int32(): T.IntegerType(),
    pa.int64(): T.LongType(),
    pa.uint8(): T.ShortType(),
    pa.uint16(): T.IntegerType(),
    pa.uint32(): T.LongType(),
    pa.uint64(): T.LongType(),
    pa.float32(): T.FloatType(),
    pa.float64(): T.DoubleType(),
    pa.string(): T.StringType(),
    pa.large_string(): T.StringType(),
    pa.binary(): T.BinaryType(),
    pa.large_binary(): T.BinaryType(),
    pa.date32(): T.DateType(),
    pa.date64(): T.DateType(),
    pa.null(): T.NullType(),
}

_BACK = {
    T.BooleanType(): pa.bool_(),
    T.ByteType(): pa.int8(),
    T.ShortType(): pa.int16(),
    T.IntegerType(): pa.int32(),
    T.LongType(): pa.int64(),
    T.FloatType(): pa.float32(),
    T.DoubleType(): pa.float64(),
    T.StringType(): pa.string(),
    T.BinaryType(): pa.binary(),
    T.DateType(): pa.date32(),
    T.TimestampType(): pa.timestamp("us", tz="UTC"),
    T.TimestampNTZType(): pa.timestamp("us"),
}


def spark_type(field: pa.Field) -> T.DataType:
    """The Spark type of one Arrow field; raises ``TypeError`` naming the column."""
    kind = field.type
    if kind in _SIMPLE:
        return _SIMPLE[kind]
    if pa.types.is_fixed_size_binary(kind):
        return T.BinaryType()
    if pa.types.is_timestamp(kind):
        return T.TimestampType() if kind.tz else T.TimestampNTZType()
    if pa.types.is_decimal128(kind):
        return T.DecimalType(kind.precision, kind.scale)
    if pa.types.is_struct(kind):
        children = [kind.field(i) for i in range(kind.num_fields)]
        return T.StructType([T.StructField(c.name, spark_type(c), c.nullable) for c in children])
    if pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_fixed_size_list(kind):
        return T.ArrayType(spark_type(kind.value_field), kind.value_field.nullable)
    if pa.types.is_map(kind):
        return T.MapType(
            spark_type(kind.key_field), spark_type(kind.item_field), kind.item_field.nullable
        )
    raise TypeError(f"column '{field.name}': no Spark type for Arrow type {kind}")


def spark_schema(schema: pa.Schema) -> T.StructType:
    """A whole Arrow schema, keeping nullability and text metadata per field."""
    fields = []
    for field in schema:
        metadata = {k.decode(): v.decode() for k, v in (field.metadata or {}).items()}
        fields.append(T.StructField(field.name, spark_type(field), field.nullable, metadata))
    return T.StructType(fields)


def arrow_field(name: str, kind: T.DataType, nullable: bool = True) -> pa.Field:
    """The Arrow field a function argument of this Spark type travels as."""
    if kind in _BACK:
        return pa.field(name, _BACK[kind], nullable)
    if isinstance(kind, T.DecimalType):
        return pa.field(name, pa.decimal128(kind.precision, kind.scale), nullable)
    if isinstance(kind, T.StructType):
        children = [arrow_field(f.name, f.dataType, f.nullable) for f in kind.fields]
        return pa.field(name, pa.struct(children), nullable)
    if isinstance(kind, T.ArrayType):
        item = arrow_field("item", kind.elementType, kind.containsNull)
        return pa.field(name, pa.list_(item), nullable)
    raise TypeError(f"argument '{name}': no Arrow type for Spark type {kind.simpleString()}")
