"""Function calls: settings, NULLs, overloads, nested values, vectors, tensors, table functions."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.functions.contract import Setting, null_strict, setting_value
from tablespan.functions.dispatch import ANY, Function, Overload, constant
from tablespan.functions.library import Library
from tablespan.functions.rowwise import sum_values
from tablespan.functions.table_functions import TableFunction
from tablespan.functions.tensors import tensor_rows, unnest_tensor
from tablespan.functions.vectors import (
    centroid_of_structs,
    distance_arrays,
    distance_structs,
    group_centroids,
)
from tablespan.plans.predicates import at
from tablespan.plans.scan import scan
from tablespan.queries.registry import given, query, read


@query("SELECT o_orderkey, 'global_scalar:' || CAST(o_orderkey AS VARCHAR) AS tagged FROM orders")
def fn_concat(spark: SparkSession, folder: str) -> DataFrame:
    tagged = F.concat(F.lit("global_scalar:"), F.col("o_orderkey").cast("string"))
    return read(spark, folder, "orders").select("o_orderkey", tagged.alias("tagged"))


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str):
    """A setting that holds while columns are being built."""
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)


MULTIPLIER = Setting("multiplier", T.IntegerType(), 1)
SCALE_FACTOR = Setting("scale_factor", T.DoubleType(), 1.0)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey * 5 AS five, l_partkey * 1 AS plain FROM lineitem
    """
)
def fn_setting_int(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("l_partkey")
    with session_setting(spark, "multiplier", "5"):
        five = key * setting_value(spark, MULTIPLIER)
    plain = key * setting_value(spark, MULTIPLIER)
    return read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", five.alias("five"), plain.alias("plain")
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity * 2.5::DOUBLE AS scaled FROM lineitem")
def fn_setting_double(spark: SparkSession, folder: str) -> DataFrame:
    with session_setting(spark, "scale_factor", "2.5"):
        scaled = F.col("l_quantity") * setting_value(spark, SCALE_FACTOR)
    return read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", scaled.alias("scaled")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * 2 AS DOUBLE) AS doubled,
           CAST(CAST(l_discount AS DECIMAL(5,2)) + CAST(l_tax AS DECIMAL(7,3)) AS DOUBLE) AS added,
           'decimal(11,2)' AS doubled_type, 'decimal(8,3)' AS added_type FROM lineitem
    """
)
def fn_decimal_promote(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    doubled = price + price
    added = F.col("l_discount").cast("decimal(5,2)") + F.col("l_tax").cast("decimal(7,3)")
    return read(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        doubled.cast("double").alias("doubled"),
        added.cast("double").alias("added"),
        F.typeof(doubled).alias("doubled_type"),
        F.typeof(added).alias("added_type"),
    )


def conditional_message(times: Column, message: Column, condition: Column) -> Column:
    return F.when(condition, F.repeat(message, times)).otherwise(F.lit(""))


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_quantity > 25 THEN repeat('Hi', 3) ELSE '' END AS fixed,
           CASE WHEN l_quantity > 10 THEN repeat('x', l_linenumber) ELSE '' END AS varying
    FROM lineitem
    """
)
def fn_conditional_message(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    message = Function(
        "conditional_message",
        [Overload([T.IntegerType(), T.StringType(), T.BooleanType()], conditional_message)],
    )
    many, few = F.col("l_quantity") > 25, F.col("l_quantity") > 10
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        message.on(lines, 3, constant("Hi"), many).alias("fixed"),
        message.on(lines, "l_linenumber", constant("x"), few).alias("varying"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(l_linenumber AS BIGINT) + NULLIF(l_suppkey, 3) + l_partkey AS total,
           CAST(l_linenumber AS BIGINT) AS alone, CAST(NULL AS BIGINT) AS nothing
    FROM lineitem
    """
)
def fn_sum_values(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    total = sum_values(lines, "l_linenumber", F.nullif("l_suppkey", F.lit(3)), "l_partkey")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        total.alias("total"),
        sum_values(lines, "l_linenumber").alias("alone"),
        sum_values(lines, "l_linenumber", F.lit(None)).alias("nothing"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_suppkey = 3 THEN NULL ELSE l_suppkey + 1 END AS strict,
           CASE WHEN l_suppkey = 3 THEN -1 ELSE l_suppkey + 1 END AS special FROM lineitem
    """
)
def fn_null_contract(spark: SparkSession, folder: str) -> DataFrame:
    """A strict function never sees the NULL it would trip over; a special one answers it."""
    lines = read(spark, folder, "lineitem")
    key = F.nullif("l_suppkey", F.lit(3))
    trips = F.when(key.isNull(), F.raise_error(F.lit("called on NULL")).cast("bigint"))
    answers = F.when(key.isNull(), F.lit(-1).cast("bigint"))
    one = T.LongType()
    strict = Function("next", [Overload([one], lambda k: null_strict([k], trips.otherwise(k + 1)))])
    special = Function(
        "next_or", [Overload([one], lambda k: answers.otherwise(k + 1), special_nulls=True)]
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        strict.on(lines, key).alias("strict"),
        special.on(lines, key).alias("special"),
    )


def _fixed_places(places: Column, prefix: Column, value: Column) -> Column:
    digits = F.concat(F.lit("%."), places.cast("string"), F.lit("f"))
    return F.concat(prefix, F.call_function("format_string", digits, value))


FORMAT_NUMBER = Function(
    "format_number",
    [
        Overload([T.DoubleType()], lambda v: F.format_string("%.0f", v)),
        Overload(
            [T.IntegerType(), T.DoubleType()],
            lambda p, v: F.call_function(
                "format_string", F.concat(F.lit("%."), p.cast("string"), F.lit("f")), v
            ),
        ),
        Overload([T.IntegerType(), T.StringType(), T.DoubleType()], _fixed_places),
    ],
)


@query(
    """
    SELECT o_orderkey,
           CAST(CAST(floor(o_totalprice + 0.5) AS BIGINT) AS VARCHAR) AS whole,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS cents,
           '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS dollars FROM orders
    """
)
def fn_format_number(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders")
    price = "o_totalprice"
    return orders.select(
        "o_orderkey",
        FORMAT_NUMBER.on(orders, price).alias("whole"),
        FORMAT_NUMBER.on(orders, 2, price).alias("cents"),
        FORMAT_NUMBER.on(orders, 2, constant("$"), price).alias("dollars"),
    )


TYPE_INFO = Function(
    "type_info",
    [
        Overload([T.IntegerType()], lambda v: F.lit("int32")),
        Overload([T.LongType()], lambda v: F.lit("int64")),
        Overload([T.LongType()], lambda v: F.lit("uint32"), unsigned=True),
        Overload([T.LongType()], lambda v: F.lit("uint64"), unsigned=True),
        Overload([T.StringType()], lambda v: F.lit("varchar")),
    ],
)


@query(
    """
    SELECT l_orderkey, l_linenumber, 'int64' AS of_key, 'int32' AS of_line, 'varchar' AS of_flag,
           'int32' AS of_short, CASE WHEN l_suppkey = 3 THEN NULL ELSE 'int64' END AS of_null
    FROM lineitem
    """
)
def fn_type_info(spark: SparkSession, folder: str) -> DataFrame:
    """Chosen by type; among equals the signed variant; a narrower integer widens."""
    lines = read(spark, folder, "lineitem")
    small = Function("type_info", TYPE_INFO.overloads[:1] + TYPE_INFO.overloads[4:])
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        TYPE_INFO.on(lines, "l_orderkey").alias("of_key"),
        TYPE_INFO.on(lines, "l_linenumber").alias("of_line"),
        TYPE_INFO.on(lines, "l_returnflag").alias("of_flag"),
        small.on(lines, F.col("l_linenumber").cast("smallint")).alias("of_short"),
        TYPE_INFO.on(lines, F.nullif("l_suppkey", F.lit(3))).alias("of_null"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS two,
           l_returnflag || '-' || l_linestatus || '-' || CAST(l_linenumber AS VARCHAR) AS five
    FROM lineitem
    """
)
def fn_concat_values(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    joined = Function(
        "concat_values",
        [Overload([ANY], lambda *v: F.concat(*[c.cast("string") for c in v]), varargs=True)],
    )
    dash = constant("-")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        joined.on(lines, "l_returnflag", "l_linestatus").alias("two"),
        joined.on(lines, "l_returnflag", dash, "l_linestatus", dash, "l_linenumber").alias("five"),
    )


#: Groups whose centroids are sent to every task; more are joined by a shuffle.
MOST_SENT = 10_000

_CENTROIDS_SQL = """
    WITH cells AS (
      SELECT label, vec_id, unnest(embedding) AS value,
             generate_subscripts(embedding, 1) - 1 AS position FROM embeddings),
    means AS (SELECT label, position, avg(CAST(value AS DOUBLE)) AS mean
              FROM cells GROUP BY label, position)
"""


@query(
    _CENTROIDS_SQL
    + """
    SELECT CAST(label AS INTEGER) AS label, CAST(position AS INTEGER) AS position,
           round(mean, 6) AS mean FROM means
    """
)
def fn_centroids(spark: SparkSession, folder: str) -> DataFrame:
    centroids = group_centroids(read(spark, folder, "embeddings"), ["label"], "embedding")
    cells = centroids.select("label", F.posexplode("centroid").alias("position", "mean"))
    return cells.select("label", "position", F.round("mean", 6).alias("mean"))


@query(
    _CENTROIDS_SQL
    + """
    SELECT c.vec_id, CAST(c.label AS INTEGER) AS label,
           round(sqrt(sum((c.value - m.mean) * (c.value - m.mean))), 5) AS distance
    FROM cells c JOIN means m ON c.label = m.label AND c.position = m.position
    GROUP BY c.vec_id, c.label
    """
)
def fn_distance_to_centroid(spark: SparkSession, folder: str) -> DataFrame:
    """Each vector's distance to its label's centroid: a join with one row per label."""
    vectors = read(spark, folder, "embeddings")
    centroids = group_centroids(vectors, ["label"], "embedding")
    distance = distance_arrays(F.col("embedding"), F.col("centroid"))
    # Vectors stay where they are as long as the centroids are few, which is counted.
    if vectors.select("label").distinct().count() <= MOST_SENT:
        centroids = F.broadcast(centroids)
    return vectors.join(centroids, "label").select(
        "vec_id", "label", F.round(distance, 5).alias("distance")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           round(sqrt((l_tax - l_discount) * (l_tax - l_discount)
                 + (l_quantity - l_linenumber) * (l_quantity - l_linenumber)), 6) AS distance,
           (l_tax + l_discount) / 2 AS mid_lat, (l_quantity + l_linenumber) / 2 AS mid_lon
    FROM lineitem
    """
)
def fn_geo_structs(spark: SparkSession, folder: str) -> DataFrame:
    a = F.struct(F.col("l_tax").alias("lat"), F.col("l_quantity").alias("lon"))
    b = F.struct(F.col("l_discount").alias("lat"), F.col("l_linenumber").alias("lon"))
    middle = centroid_of_structs([a, b], ["lat", "lon"])
    return read(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(distance_structs(a, b, ["lat", "lon"]), 6).alias("distance"),
        middle.getField("lat").alias("mid_lat"),
        middle.getField("lon").alias("mid_lon"),
    )


@query(
    """
    SELECT c_custkey, 'CAFE' || hex(encode(c_name)) || '7631'
           || lpad(hex(c_nationkey), 2, '0') AS packet FROM customer
    """
)
def fn_binary_packet(spark: SparkSession, folder: str) -> DataFrame:
    """Header, payload, label and a one-byte version, joined as bytes."""
    version = F.unhex(F.lpad(F.hex("c_nationkey"), 2, "0"))
    packet = F.concat(
        F.unhex(F.lit("CAFE")), F.encode("c_name", "UTF-8"), F.encode(F.lit("v1"), "UTF-8"), version
    )
    return read(spark, folder, "customer").select("c_custkey", F.hex(packet).alias("packet"))


@query(
    """
    SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i,
           unnest(embedding) AS value FROM embeddings
    """
)
def fn_unnest_tensor(spark: SparkSession, folder: str) -> DataFrame:
    labels = F.sequence(F.lit(0), F.size("embedding") - 1)
    vectors = read(spark, folder, "embeddings")
    return tensor_rows(vectors, F.col("embedding"), {"i": labels}, keep=("vec_id",))


@query(
    """
    WITH cells AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS p,
                          unnest(embedding) AS value FROM embeddings)
    SELECT vec_id, 'r' || CAST(p // 8 AS VARCHAR) AS r, CAST(p % 8 AS INTEGER) AS c, value FROM cells
    """
)
def fn_unnest_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """The same for two axes: each vector as a matrix with rows of eight."""
    rows = F.sequence(F.lit(0), F.ceil(F.size("embedding") / 8).cast("int") - 1)
    matrix = F.transform(rows, lambda r: F.slice(F.col("embedding"), r * 8 + 1, 8))
    axes = {
        "r": F.transform(rows, lambda r: F.concat(F.lit("r"), r.cast("string"))),
        "c": F.sequence(F.lit(0), F.lit(7)),
    }
    cells = unnest_tensor(matrix, axes)
    rows = read(spark, folder, "embeddings").select("vec_id", F.explode(cells).alias("cell"))
    return rows.select("vec_id", "cell.axes.r", "cell.axes.c", "cell.value")


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice, {'priority': o_orderpriority,
           'steps': [o_orderstatus, 'done']}.priority AS priority,
           [o_orderstatus, 'done'][2] AS last_step FROM orders
    """
)
def fn_nested_values(spark: SparkSession, folder: str) -> DataFrame:
    """Structs and lists go into a typed call and come out of it."""
    orders = read(spark, folder, "orders")
    detail = F.struct(
        F.col("o_orderpriority").alias("priority"),
        F.array(F.col("o_orderstatus"), F.lit("done")).alias("steps"),
    )
    identity = Function("identity", [Overload([ANY], lambda v: v)])
    same = identity.on(orders, detail)
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        same.getField("priority").alias("priority"),
        same.getField("steps")[1].alias("last_step"),
    )


@query(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'F/' || o_orderpriority
           ELSE o_orderstatus END AS path, o_totalprice + 1 AS total FROM orders
    """
)
def fn_nested_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Overloads with an array and a struct parameter; what may be NULL inside does not matter."""
    orders = read(spark, folder, "orders")
    steps = T.ArrayType(T.StringType(), containsNull=False)
    joined = Function(
        "show",
        [
            Overload([steps], lambda a: F.array_join(a, "/")),
            Overload([T.StructType().add("price", T.DoubleType(), False)], lambda s: s.getField("price") + 1),
        ],
    )
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    path = F.when(status == "F", F.array(status, priority)).otherwise(F.array(status))
    return orders.select(
        "o_orderkey",
        joined.on(orders, path).alias("path"),
        joined.on(orders, F.struct(F.col("o_totalprice").alias("price"))).alias("total"),
    )


def _orders_between(
    spark: SparkSession, folder: str, low: float, high: float, with_customer: bool
) -> DataFrame:
    columns = ["o_orderkey", "o_totalprice"] + (["o_custkey"] if with_customer else [])
    where = at("o_totalprice").between(low, high)
    return scan(spark, given(folder, "orders"), where=where, columns=columns)


LIBRARY = Library()
LIBRARY.add(
    "orders_between",
    TableFunction(
        "orders_between",
        [
            ("folder", T.StringType()),
            ("low", T.DoubleType()),
            ("high", T.DoubleType()),
            ("with_customer", T.BooleanType()),
        ],
        _orders_between,
    ),
)


@query(
    """
    SELECT o_orderkey, o_totalprice, o_custkey FROM orders
    WHERE o_totalprice BETWEEN 100000 AND 120000
    """
)
def table_function_call(spark: SparkSession, folder: str) -> DataFrame:
    """The last argument decides whether the result has a customer column."""
    return LIBRARY.table(spark, "Orders_Between", folder, 100000.0, 120000.0, True)


@query(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 120000"
)
def table_function_narrow(spark: SparkSession, folder: str) -> DataFrame:
    """The same call without the customer column."""
    return LIBRARY.table(spark, "Orders_Between", folder, 100000.0, 120000.0, False)


@query(
    """
    SELECT o_orderpriority, count(*) AS n FROM orders
    WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY o_orderpriority
    """
)
def table_function_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same idea from SQL: a temporary table function over a scan published as a view."""
    view = "tablespan_orders"
    scan(spark, given(folder, "orders")).createOrReplaceTempView(view)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION tablespan_orders_since(since STRING)
        RETURNS TABLE (o_orderkey BIGINT, o_orderpriority STRING)
        RETURN SELECT o_orderkey, o_orderpriority FROM {view}
        WHERE o_orderdate >= CAST(since AS TIMESTAMP_NTZ)"""
    )
    rows = spark.sql(
        "SELECT * FROM tablespan_orders_since(:since)", args={"since": "1999-01-01"}
    )
    return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
