import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.arrow_types import arrow_field, spark_schema, spark_type
from tablespan.operators.schema import conform, show_row_id, widens


@pytest.mark.parametrize(
    "arrow, expected",
    [
        (pa.bool_(), "boolean"),
        (pa.int8(), "tinyint"),
        (pa.int16(), "smallint"),
        (pa.int32(), "int"),
        (pa.int64(), "bigint"),
        (pa.uint8(), "smallint"),
        (pa.uint16(), "int"),
        (pa.uint32(), "bigint"),
        (pa.uint64(), "bigint"),
        (pa.float32(), "float"),
        (pa.float64(), "double"),
        (pa.large_string(), "string"),
        (pa.binary(4), "binary"),
        (pa.large_binary(), "binary"),
        (pa.date32(), "date"),
        (pa.timestamp("us", tz="Europe/Berlin"), "timestamp"),
        (pa.timestamp("ns"), "timestamp_ntz"),
        (pa.decimal128(12, 3), "decimal(12,3)"),
        (pa.null(), "void"),
        (pa.list_(pa.int32(), 3), "array<int>"),
        (pa.large_list(pa.string()), "array<string>"),
        (pa.map_(pa.string(), pa.uint32()), "map<string,bigint>"),
        (pa.struct([("a", pa.uint8()), ("b", pa.list_(pa.date32()))]), "struct<a:smallint,b:array<date>>"),
    ],
)
def test_arrow_to_spark(arrow, expected):
    assert spark_type(pa.field("c", arrow)).simpleString() == expected


@pytest.mark.parametrize(
    "arrow",
    [pa.time64("us"), pa.duration("s"), pa.float16(), pa.month_day_nano_interval(), pa.decimal256(50, 2)],
)
def test_unmappable_arrow_types_name_the_column(arrow):
    with pytest.raises(TypeError, match="'odd'"):
        spark_type(pa.field("odd", arrow))


def test_nullability_and_metadata_are_kept():
    inner = pa.struct([pa.field("x", pa.int32(), nullable=False)])
    schema = spark_schema(
        pa.schema(
            [
                pa.field("id", pa.int64(), nullable=False, metadata={"is_row_id": ""}),
                pa.field("l", pa.list_(pa.field("item", inner, nullable=False))),
            ]
        )
    )
    assert not schema["id"].nullable and schema["id"].metadata == {"is_row_id": ""}
    assert not schema["l"].dataType.containsNull
    assert not schema["l"].dataType.elementType["x"].nullable


@pytest.mark.parametrize(
    "kind",
    [T.LongType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.DecimalType(9, 4),
     T.ArrayType(T.StructType([T.StructField("a", T.ShortType())]))],
)
def test_spark_to_arrow_and_back(kind):
    assert spark_type(arrow_field("c", kind)).simpleString() == kind.simpleString()


def test_maps_do_not_travel_as_arguments():
    with pytest.raises(TypeError, match="'m'"):
        arrow_field("m", T.MapType(T.StringType(), T.LongType()))


def test_conform_maps_by_position_and_widens(spark):
    frame = spark.createDataFrame([Row(b=1, a=2.5)], "b int, a float")
    schema = T.StructType.fromDDL("a bigint, b double")
    result = conform(frame, schema)
    assert result.schema.simpleString() == "struct<a:bigint,b:double>"
    assert result.first() == Row(a=1, b=2.5)


def test_conform_renames_nested_fields(spark):
    frame = spark.sql("SELECT named_struct('x', 1, 'y', array(cast(2 as short))) AS s")
    schema = T.StructType.fromDDL("t struct<p: bigint, q: array<int>>")
    assert conform(frame, schema).first().t == Row(p=1, q=[2])


@pytest.mark.parametrize(
    "actual, declared",
    [("bigint", "int"), ("double", "float"), ("bigint", "double"), ("string", "int"),
     ("timestamp", "timestamp_ntz"), ("decimal(10,2)", "decimal(10,3)"), ("int", "string"),
     ("struct<a:int>", "struct<a:int,b:int>")],
)
def test_lossy_reading_is_refused(spark, actual, declared):
    frame = spark.createDataFrame([], f"c {actual}")
    with pytest.raises(TypeError, match="column 'd'"):
        conform(frame, T.StructType.fromDDL(f"d {declared}"))


def test_column_count_must_agree(spark):
    with pytest.raises(ValueError, match="has 1 columns, the declared schema has 2"):
        conform(spark.range(1), T.StructType.fromDDL("a bigint, b bigint"))


def test_unsigned_long_reads_exactly_or_raises(spark):
    schema = T.StructType.fromDDL("n bigint")
    frame = spark.createDataFrame([(Decimal(2**63 - 1),)], "u decimal(20,0)")
    assert conform(frame, schema).first().n == 2**63 - 1
    frame = spark.createDataFrame([(Decimal(2**63),)], "u decimal(20,0)")
    with pytest.raises(Exception, match="above 2\\^63-1"):
        conform(frame, schema).collect()


def test_widening_table():
    assert widens(T.NullType(), T.DateType())
    assert widens(T.IntegerType(), T.DecimalType(12, 2))
    assert not widens(T.IntegerType(), T.DecimalType(11, 2))
    assert widens(T.MapType(T.StringType(), T.ByteType()), T.MapType(T.StringType(), T.LongType()))


def test_row_id_is_shown_under_its_own_name(spark):
    tagged = F.struct(F.lit(0).alias("a"), F.lit("s_0").alias("b"))
    frame = spark.range(1).select(tagged.alias("key", metadata={"is_row_id": ""}), "id")
    shown = show_row_id(frame)
    assert shown.columns == ["rowid", "id"]
    assert shown.select("rowid.b").first().b == "s_0"


def test_awkward_names_survive(spark):
    frame = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    result = conform(frame, T.StructType([T.StructField("x.y", T.LongType()), T.StructField("z", T.IntegerType())]))
    assert result.columns == ["x.y", "z"] and tuple(result.first()) == (1, 2)


def test_dates_are_left_alone(spark):
    frame = spark.createDataFrame([(dt.date(2020, 1, 1),)], "d date")
    assert conform(frame, frame.schema).first().d == dt.date(2020, 1, 1)
