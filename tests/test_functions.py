import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.functions.contract import Setting, null_strict, setting_value
from tablespan.functions.dispatch import ANY, DispatchError, Function, Overload, constant
from tablespan.functions.rowwise import sum_values
from tablespan.functions.library import Library, UnknownFunctionError
from tablespan.functions.table_functions import TableFunction
from tablespan.functions.tensors import tensor_rows, unnest_tensor
from tablespan.functions.vectors import (
    centroid_of_structs,
    distance_arrays,
    distance_structs,
    group_centroids,
)
from tablespan.queries.aggregates import CommonDivisor
from tablespan.queries.calls import FORMAT_NUMBER, TYPE_INFO, conditional_message
from tablespan.sources.sequences import split_sequence

BYTE, SHORT, INT, LONG = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()
DOUBLE, TEXT, BOOLEAN = T.DoubleType(), T.StringType(), T.BooleanType()


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def value(frame, column):
    return frame.select(column.alias("v")).first().v


def named(label, *parameters, **options):
    return Overload(list(parameters), lambda *_: F.lit(label), **options)


@pytest.mark.parametrize("stable", [True, False])
def test_values_that_are_not_deterministic_stay_where_they_are(spark, stable):
    f = Function("f", [Overload([LONG], lambda n: n * 2 + 1, deterministic=stable)])
    frame = spark.range(20)
    called = frame.select("id", f.on(frame, F.col("id")).alias("v"))
    rows = called.where("v > 9")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.index("Filter") < plan.index("Project")) == (not stable)  # the outer step comes first
    assert sorted(r.v for r in rows.collect()) == [2 * n + 1 for n in range(5, 20)]
    empty = spark.createDataFrame([(None,)], "id long")
    assert value(empty, f.on(empty, F.col("id"))) is None


def test_number_formats_by_arity(one):
    assert value(one, FORMAT_NUMBER.on(one, F.expr("3.14"))) == "3"
    assert value(one, FORMAT_NUMBER.on(one, 2, 3.14159)) == "3.14"
    assert value(one, FORMAT_NUMBER.on(one, 2, constant("$"), 3.14159)) == "$3.14"
    with pytest.raises(DispatchError, match="does not take 4"):
        FORMAT_NUMBER.on(one, 1, 2, 3, 4)


def test_type_info_by_type(one):
    assert value(one, TYPE_INFO.on(one, F.expr("42"))) == "int32"
    assert value(one, TYPE_INFO.on(one, F.expr("42L"))) == "int64"
    assert value(one, TYPE_INFO.on(one, constant("hello"))) == "varchar"
    with pytest.raises(DispatchError, match=r"no variant for \(boolean\)"):
        TYPE_INFO.on(one, True)


def test_exact_beats_widening_and_widening_beats_nothing():
    f = Function("f", [named("short", SHORT), named("long", LONG), named("double", DOUBLE)])
    assert f.choose([SHORT]).parameters == [SHORT]
    assert f.choose([T.DecimalType(3, 2)]).parameters == [DOUBLE]
    with pytest.raises(DispatchError, match="ambiguous"):
        f.choose([BYTE])
    with pytest.raises(DispatchError, match="no variant"):
        f.choose([T.FloatType()])


def test_signed_variants_win_a_tie_only_when_single():
    tie = Function("f", [named("u", LONG, unsigned=True), named("s", LONG)])
    assert not tie.choose([LONG]).unsigned
    with pytest.raises(DispatchError, match="ambiguous"):
        Function("f", [named("u", LONG, unsigned=True), named("v", LONG, unsigned=True)]).choose([LONG])
    with pytest.raises(DispatchError, match="ambiguous"):
        Function("f", [named("a", ANY), named("b", LONG)]).choose([LONG])


def test_null_literal_fits_any_parameter(one):
    f = Function("f", [Overload([TEXT], F.upper, special_nulls=True)])
    assert f.on(one, F.lit(None)) is not None
    echo = Function("echo", [Overload([ANY], lambda v: F.typeof(v), special_nulls=True)])
    assert value(one, echo.on(one, F.lit(None))) == "bigint"
    typed = Function("typed", [Overload([TEXT], lambda v: F.typeof(v), special_nulls=True)])
    assert value(one, typed.on(one, F.lit(None))) == "string"


def test_varargs_take_the_rest_each_with_its_own_type(one):
    f = Function("f", [Overload([INT, ANY], lambda n, *rest: F.concat_ws(",", *[F.typeof(r) for r in rest]), varargs=True)])
    assert value(one, f.on(one, 1, F.expr("2L"), constant("x"), True)) == "bigint,string,boolean"
    assert value(one, f.on(one, 1)) == ""
    with pytest.raises(DispatchError, match="does not take 0"):
        f.on(one)
    tails = Function("g", [named("a", INT, varargs=True), named("b", TEXT, varargs=True)])
    with pytest.raises(DispatchError, match="ambiguous"):
        tails.choose([INT, INT])


def test_malformed_declarations_are_refused():
    with pytest.raises(ValueError):
        Overload([], F.lit, varargs=True)
    with pytest.raises(TypeError):
        Overload(["table"], F.lit)
    with pytest.raises(DispatchError, match="map"):
        Overload([T.MapType(TEXT, LONG)], F.lit)


def test_map_arguments_are_refused_at_any_depth(one):
    f = Function("f", [named("any", ANY)])
    with pytest.raises(DispatchError, match="map"):
        f.on(one, F.expr("array(named_struct('m', map('a', 1)))"))


def test_strict_functions_are_not_called_on_null(spark):
    frame = spark.createDataFrame([(1, 2), (None, 2)], "a int, b int")
    boom = F.when(F.col("a").isNull(), F.raise_error(F.lit("called")).cast("int")).otherwise(F.col("a"))
    assert [r.v for r in frame.select(null_strict([F.col("a"), F.col("b")], boom).alias("v")).collect()] == [1, None]
    special = Function("f", [Overload([INT], lambda v: F.coalesce(v, F.lit(-1)), special_nulls=True)])
    assert [r.v for r in frame.select(special.on(frame, "a").alias("v")).collect()] == [1, -1]


@pytest.mark.parametrize(
    "kind, text, expected",
    [(INT, "5", 5), (LONG, "7", 7), (DOUBLE, "2.5", 2.5), (BOOLEAN, "TRUE", True), (BOOLEAN, "no", False), (TEXT, "x", "x")],
)
def test_settings_are_typed(spark, one, kind, text, expected):
    setting = Setting("tablespan_probe", kind, None)
    spark.conf.set("tablespan_probe", text)
    try:
        column = setting_value(spark, setting)
    finally:
        spark.conf.unset("tablespan_probe")
    assert value(one, column) == expected
    assert value(one, setting_value(spark, setting)) is None


def test_settings_follow_set_and_reset(spark, one):
    multiplier = Setting("multiplier", INT, 1)
    spark.sql("SET multiplier=5")
    assert value(one, F.lit(4) * setting_value(spark, multiplier)) == 20
    spark.sql("RESET multiplier")
    assert value(one, F.lit(4) * setting_value(spark, multiplier)) == 4


def test_settings_without_a_text_form_and_malformed_ones(spark, one):
    spark.conf.set("tablespan_probe", "12")
    try:
        assert value(one, setting_value(spark, Setting("tablespan_probe", T.BinaryType(), b"d"))) == bytearray(b"d")
        with pytest.raises(ValueError):
            spark.conf.set("tablespan_probe", "five")
            setting_value(spark, Setting("tablespan_probe", INT, 1))
    finally:
        spark.conf.unset("tablespan_probe")


def test_decimals_promote(one):
    price = F.lit("1.25").cast("decimal(10,2)")
    assert str(value(one, price + price)) == "2.50"
    total = F.lit("1.50").cast("decimal(5,2)") + F.lit("2.250").cast("decimal(7,3)")
    assert str(value(one, total)) == "3.750"


def test_conditional_message(spark, one):
    call = Function("conditional_message", [Overload([INT, TEXT, BOOLEAN], conditional_message)])
    asked = [(3, "Hi", True), (3, "Hello", False), (1, "Hello", True), (0, "Test", True)]
    found = [value(one, call.on(one, n, constant(m), c)) for n, m, c in asked]
    assert found == ["HiHiHi", "", "Hello", ""]
    frame = spark.createDataFrame([(1,), (2,), (3,), (2,), (1,)], "n int")
    rows = frame.select("n", call.on(frame, "n", constant("x"), True).alias("v")).orderBy("n").collect()
    assert [r.v for r in rows] == ["x", "x", "xx", "xx", "xxx"]


def test_sum_values(spark, one):
    lit = F.lit
    assert value(one, sum_values(one, lit(10), lit(20))) == 30
    assert value(one, sum_values(one, *[lit(10 * i) for i in range(1, 6)])) == 150
    assert value(one, sum_values(one, lit(42))) == 42
    assert value(one, sum_values(one, lit(1), lit(None), lit(3))) is None
    assert one.select(sum_values(one, lit(1).cast("tinyint")).alias("v")).schema["v"].dataType == LONG
    frame = spark.createDataFrame([(1, 2, 3), (None, 5, 6), (7, 8, 9)], "a int, b int, c int")
    total = frame.select(sum_values(frame, "a", "b", "c").alias("v"))
    assert [r.v for r in total.orderBy(F.asc_nulls_last("v")).collect()] == [6, 24, None]
    with pytest.raises(DispatchError, match="at least one"):
        sum_values(one)
    with pytest.raises(DispatchError, match="string"):
        sum_values(one, lit("x"))


def point(lat, lon):
    return F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))


def test_distances_and_centroid_of_a_row(one):
    axes = ["lat", "lon"]
    assert value(one, distance_structs(point(0.0, 0.0), point(3.0, 4.0), axes)) == 5.0
    a, b = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(3.0), F.lit(4.0))
    assert value(one, distance_arrays(a, b)) == 5.0
    assert value(one, distance_arrays(a, F.array(F.lit(1.0)))) is None
    assert value(one, centroid_of_structs([point(0.0, 0.0), point(4.0, 6.0)], axes)) == Row(lat=2.0, lon=3.0)


def test_group_centroids_with_a_group_of_a_third_of_all_rows(spark):
    frame = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0L, id) AS g", "array(cast(id % 2 AS double), 1d) AS v"
    )
    rows = group_centroids(frame, ["g"], "v")
    assert rows.count() == 2001
    assert rows.where("g = 0").first().centroid == [0.5, 1.0]


def test_binary_packet(one):
    packet = F.concat(
        F.expr("X'CAFE'"), F.expr("X'0102'"), F.encode(F.lit("v1"), "UTF-8"), F.unhex(F.lpad(F.hex(F.lit(1)), 2, "0"))
    )
    assert value(one, F.hex(packet)) == "CAFE0102763101"


def test_unnest_tensor(one):
    tensor = F.array(F.lit(10), F.lit(20), F.lit(30))
    cells = value(one, unnest_tensor(tensor, {"i": F.array(F.lit(0), F.lit(1), F.lit(2))}))
    assert [(c.value, c.axes.i) for c in cells] == [(10, 0), (20, 1), (30, 2)]


def test_unnest_three_axes(spark):
    frame = spark.sql("SELECT 7 AS k, array(array(array(1,2),array(3,4)),array(array(5,6),array(7,8))) AS t")
    axes = {"x": F.expr("array('a','b')"), "y": F.expr("array(10,20)"), "z": F.expr("array(0.5D,1.5D)")}
    rows = tensor_rows(frame, F.col("t"), axes, keep=("k",)).collect()
    assert tuple(rows[0]) == (7, "a", 10, 0.5, 1)
    assert tuple(rows[5]) == (7, "b", 10, 1.5, 6)
    assert len(rows) == 8
    with pytest.raises(ValueError):
        unnest_tensor(F.col("t"), {})


LIBRARY = Library()
LIBRARY.add("split_sequence", TableFunction("split_sequence", [("n", LONG), ("splits", INT)], split_sequence))
LIBRARY.add(
    "Columns",
    TableFunction("columns", [("n", INT)], lambda s, n: s.range(1).select(*[F.lit(i).alias(f"c{i}") for i in range(n or 1)])),
    ("extra",),
)
LIBRARY.add("format_number", FORMAT_NUMBER)
LIBRARY.add("divisor", CommonDivisor())


def test_table_functions(spark):
    rows = LIBRARY.table(spark, "SPLIT_sequence", 30, 6)
    assert sorted(r.n for r in rows.collect()) == list(range(30))
    assert LIBRARY.table(spark, "split_sequence", 5, 2, namespace=("main",)).count() == 5
    assert LIBRARY.table(spark, "columns", 3, namespace=("extra",)).columns == ["c0", "c1", "c2"]
    assert LIBRARY.table(spark, "columns", None, namespace=("extra",)).columns == ["c0"]
    assert LIBRARY.names("table") == ["split_sequence"]
    assert LIBRARY.names("table", ("extra",)) == ["Columns"]


def test_column_functions_and_aggregates_by_name(spark, one):
    assert value(one, LIBRARY.column(one, "Format_Number", 2, 3.14159)) == "3.14"
    assert LIBRARY.names("column") == ["format_number"]
    frame = spark.createDataFrame([(1, 12), (1, 18)], "k int, i int")
    assert LIBRARY.aggregate(frame, ["k"], "divisor", ["i"]).first().asDict() == {"k": 1, "divisor": 6}
    with pytest.raises(UnknownFunctionError, match="column function main.divisor"):
        LIBRARY.column(one, "divisor", 1)


def test_names_are_taken_once_and_the_first_aggregate_stays(one):
    library = Library()
    library.add("f", FORMAT_NUMBER)
    with pytest.raises(ValueError, match="already"):
        library.add("F", TYPE_INFO)
    first, second = CommonDivisor(), CommonDivisor()
    library.add("a", first)
    library.add("a", second)
    assert library._find("aggregate", "a", None) is first


def test_table_function_refusals(spark):
    with pytest.raises(UnknownFunctionError, match="main.columns"):
        LIBRARY.table(spark, "columns", 1)
    with pytest.raises(TypeError, match="takes 2 argument"):
        LIBRARY.table(spark, "split_sequence", 1)
    with pytest.raises(TypeError, match="'n' must be a bigint"):
        LIBRARY.table(spark, "split_sequence", "1", 2)
    with pytest.raises(TypeError, match="'n' must be a bigint"):
        LIBRARY.table(spark, "split_sequence", True, 2)
    for kind in (T.DateType(), T.TimestampType(), T.DecimalType(5, 2), T.ArrayType(LONG)):
        with pytest.raises(TypeError, match="cannot be"):
            TableFunction("f", [("p", kind)], split_sequence)
