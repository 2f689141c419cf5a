"""Scans: branches, declared schemas, text files, row ids, versions, filters, statistics."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.asof import latest_as_of
from tablespan.operators.sketches import measured_parts
from tablespan.operators.statistics import column_statistics, profile_branches
from tablespan.plans.catalog import Catalog
from tablespan.plans.predicates import Bounds, at
from tablespan.plans.scan import scan
from tablespan.plans.tables import Table, Version, VersionedTable
from tablespan.queries.registry import given, new_folder, path_of, query, read
from tablespan.sources.branches import (
    format_branch,
    frame_branch,
    function_branch,
    partitioned_files,
    scan_function,
)
from tablespan.sources.manifest import measured_files, with_key_filters
from tablespan.sources.sequences import range_of, sequence

ORDERS = (
    T.StructType()
    .add("o_orderkey", T.LongType())
    .add("o_custkey", T.LongType())
    .add("o_orderstatus", T.StringType())
    .add("o_totalprice", T.DoubleType())
    .add("o_orderdate", T.TimestampNTZType())
    .add("o_orderpriority", T.StringType())
)


def since(year: int) -> str:
    """A condition on the order date that file scans can use to skip row groups."""
    return f"(o_orderdate >= TIMESTAMP_NTZ '{year}-01-01')"


def orders_by_status(folder: str) -> Table:
    """Orders from a branch per status and one for the rest; a scan must limit the order date."""
    source = scan_function("read_parquet", path_of(folder, "orders"))
    return Table(
        "orders",
        (
            *(source.filtered(f"o_orderstatus = '{s}'") for s in ("F", "O", "P")),
            source.filtered("o_orderstatus NOT IN ('F', 'O', 'P') OR o_orderstatus IS NULL"),
        ),
        ORDERS,
        exclusive=True,
        required_filters=((("o_orderdate",),),),
    )


@query(
    """
    SELECT o_orderpriority, count(*) AS n_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM (SELECT * FROM orders WHERE o_orderstatus = 'F'
          UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P'
          UNION ALL SELECT * FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P') OR o_orderstatus IS NULL)
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY o_orderpriority
    """
)
def scan_branch_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan(
        spark, orders_by_status(folder), where=at("o_orderdate") >= dt.datetime(1996, 1, 1)
    )
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), total.alias("total")
    )


@query(
    """
    SELECT s_suppkey AS party_key, s_name AS party_name, CAST(s_nationkey AS BIGINT) AS nation,
           s_acctbal AS balance FROM supplier WHERE s_acctbal > 1000
    UNION ALL
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT), c_acctbal FROM customer
    WHERE c_acctbal > 1000
    """
)
def scan_branch_rename(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType.fromDDL(
        "party_key bigint, party_name string, nation bigint, balance double"
    )
    customers = read(spark, folder, "customer").drop("c_mktsegment")
    parties = Table(
        "parties",
        (
            scan_function("read_parquet", path_of(folder, "supplier")),
            frame_branch(customers, "customers"),
        ),
        schema,
    )
    return scan(spark, parties, where=at("balance") > 1000.0)


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000
    """
)
def scan_file_list(spark: SparkSession, folder: str) -> DataFrame:
    path = path_of(folder, "orders")
    table = Table("orders_twice", (scan_function("read_parquet", [path, path]),))
    return scan(
        spark, table, where=at("o_totalprice") > 400000.0, columns=["o_orderkey", "o_totalprice"]
    )


@query(
    """
    SELECT c_custkey AS custkey, NULLIF(c_mktsegment, 'BUILDING') AS segment,
           c_acctbal AS balance, c_acctbal > 0 AS solvent, CAST(NULL AS VARCHAR) AS phone
    FROM customer
    """
)
def scan_text_branch(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark)
    read(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_custkey").alias("custkey"),
        (F.col("c_acctbal") > 0).alias("solvent"),
        F.col("c_acctbal").alias("balance"),
    ).write.option("header", True).option("sep", "|").csv(path)
    schema = T.StructType.fromDDL(
        "custkey bigint, segment string, balance double, solvent boolean, phone string"
    )
    options = {"delim": "|", "header": True, "nullstr": "BUILDING"}
    return scan(spark, Table("customers", (format_branch("csv", [path], options),), schema))


@query(
    """
    SELECT p_partkey AS partkey, p_size AS size, p_retailprice AS price, NULLIF(p_brand, 'Brand#1')
           AS brand FROM part
    """
)
def scan_text_positional(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark)
    brand = F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand"))
    line = F.concat_ws(";", "p_partkey", "p_size", "p_retailprice", brand)
    read(spark, folder, "part").select(line).write.text(path)
    schema = T.StructType.fromDDL("partkey bigint, size int, price double, brand string")
    branch = format_branch("csv", [path], {"delim": ";"})
    return scan(spark, Table("parts", (branch,), schema))


@query("SELECT p_partkey AS partkey, p_name AS name, p_size AS size FROM part")
def scan_csv_delegated(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark)
    read(spark, folder, "part").select("p_partkey", "p_name", "p_size").write.csv(path)
    rows = scan(spark, Table("parts", (scan_function("read_csv", path),)))
    return rows.select(
        F.col("_c0").cast("bigint").alias("partkey"),
        F.col("_c1").alias("name"),
        F.col("_c2").cast("int").alias("size"),
    )


@query("SELECT s_suppkey AS id, s_acctbal AS balance, CAST(s_nationkey AS BIGINT) AS nation FROM supplier")
def scan_arrow_schema(spark: SparkSession, folder: str) -> DataFrame:
    """A table declared by an Arrow schema, which widens what the file has."""
    schema = pa.schema([("id", pa.int64()), ("balance", pa.float64()), ("nation", pa.int64())])
    suppliers = read(spark, folder, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    return scan(spark, Table("suppliers", (frame_branch(suppliers),), schema))


@query(
    """
    SELECT o_orderpriority, count(*) AS n_orders, CAST(0 AS BIGINT) AS n_returned
    FROM orders GROUP BY o_orderpriority
    """
)
def scan_empty(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType.fromDDL("orderkey bigint, returned_on date")
    returned = scan(spark, Table("returned", (), schema, planning="filtered"))
    orders = read(spark, folder, "orders")
    joined = orders.join(returned, orders["o_orderkey"] == returned["orderkey"], "left")
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("orderkey").alias("n_returned")
    )


def _year_dates(values: dict[str, str | None]) -> dict:
    """What the files of a year tell about the order date."""
    if values["year"] is None:
        return {}
    year = int(values["year"])
    last = dt.datetime(year, 12, 31, 23, 59, 59, 999_999)
    return {("o_orderdate",): Bounds(dt.datetime(year, 1, 1), last)}


@query(
    """
    SELECT year(o_orderdate) AS year, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high
    FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY year(o_orderdate)
    """
)
def scan_planned_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files planned by year; the scan lists those a filter may need and filters the rows."""
    path = _by_year(spark, folder)
    table = Table("orders", partitioned_files(spark, path, _year_dates), ORDERS, planning="filtered")
    rows = scan(spark, table, where=at("o_orderdate") < dt.datetime(1997, 1, 1))
    return rows.groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderkey").alias("low"),
        F.max("o_orderkey").alias("high"),
    )


def _by_year(spark: SparkSession, folder: str) -> str:
    """Orders in a folder for each year and month, as their owner might keep them."""
    path = new_folder(spark)
    dated = read(spark, folder, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    dated.repartition("year", "month").write.partitionBy("year", "month").parquet(path)
    return path


@query(
    """
    SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high, min(month(o_orderdate)) AS first_month
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-02-10' AND o_orderdate < TIMESTAMP '1997-04-01' GROUP BY o_orderpriority
    """
)
def scan_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The same folders by a manifest with measured ranges: one read of the files of three months."""
    path = _by_year(spark, folder)
    schema = T.StructType([*ORDERS.fields, T.StructField("month", T.LongType())])
    files = measured_files(spark, path, schema, [("o_orderdate",)])
    when = at("o_orderdate")
    where = [when >= dt.datetime(1997, 2, 10), when < dt.datetime(1997, 4, 1)]
    rows = scan(spark, Table("orders", (files.branch(),), schema), where=where)
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderkey").alias("low"),
        F.max("o_orderkey").alias("high"),
        F.min("month").alias("first_month"),
    )


@query(
    """
    SELECT o_custkey, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high
    FROM orders WHERE o_custkey IN (37, 74, 110, 111) GROUP BY o_custkey
    """
)
def scan_key_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of some customers, whose keys lie inside the range of every file: key filters choose the files."""
    path = new_folder(spark)
    share = F.pmod(F.xxhash64("o_custkey"), F.lit(32))
    orders = read(spark, folder, "orders").withColumn("share", share)
    orders.repartition("share").write.partitionBy("share").parquet(path)
    customer = ("o_custkey",)
    files = with_key_filters(spark, measured_files(spark, path, ORDERS, [customer]), [customer])
    rows = scan(spark, Table("orders", (files.branch(),), ORDERS), where=at("o_custkey").isin(37, 74, 110, 111))
    return rows.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderkey").alias("low"),
        F.max("o_orderkey").alias("high"),
    )


@query(
    """
    WITH size AS (SELECT max(l_orderkey) + 1 AS total FROM lineitem),
    numbers AS (SELECT unnest(range(total)) AS n, total // 5 AS q, total % 5 AS r FROM size),
    placed AS (SELECT n, CASE WHEN n < r * (q + 1) THEN n // (q + 1)
                              ELSE r + (n - r * (q + 1)) // q END AS part FROM numbers)
    SELECT part % 2 AS bucket, count(*) AS n_keys, min(n) AS low, max(n) AS high,
           count(*) FILTER (WHERE n NOT IN (SELECT l_orderkey FROM lineitem)) AS n_unused
    FROM placed GROUP BY part % 2
    """
)
def split_sequence_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Order keys that no line item uses, counted by the five ranges that hold them; the session decides on tasks."""
    lines = read(spark, folder, "lineitem")
    total = lines.agg(F.coalesce(F.max("l_orderkey") + 1, F.lit(0))).first()[0]
    table = Table("keys", (function_branch(sequence, total),))
    keys = scan(spark, table)
    used = lines.select("l_orderkey").distinct().withColumn("used", F.lit(True))
    marked = keys.join(used, keys["n"] == used["l_orderkey"], "left")
    return marked.groupBy((range_of(F.col("n"), total, 5) % 2).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.min("n").alias("low"),
        F.max("n").alias("high"),
        F.count_if(F.col("used").isNull()).alias("n_unused"),
    )


def _with_row_id(schema: str, name: str) -> T.StructType:
    fields = [
        T.StructField(f.name, f.dataType, f.nullable, {"is_row_id": ""} if f.name == name else {})
        for f in T.StructType.fromDDL(schema).fields
    ]
    return T.StructType(fields)


@query("SELECT c_custkey AS rowid, c_name AS name FROM customer")
def rowid_scan(spark: SparkSession, folder: str) -> DataFrame:
    schema = _with_row_id("custkey bigint, name string", "custkey")
    source = frame_branch(read(spark, folder, "customer").select("c_custkey", "c_name"))
    return scan(spark, Table("customers", (source,), schema))


@query(
    """
    SELECT o_custkey AS a, 's_' || CAST(o_orderkey AS VARCHAR) AS b, o_totalprice AS price
    FROM orders WHERE o_custkey <> o_orderkey
    """
)
def rowid_struct(spark: SparkSession, folder: str) -> DataFrame:
    schema = _with_row_id("id struct<a: bigint, b: string>, price double", "id")
    key = F.struct("o_custkey", F.concat(F.lit("s_"), F.col("o_orderkey").cast("string")))
    source = frame_branch(read(spark, folder, "orders").select(key, "o_totalprice"))
    rows = scan(spark, Table("orders", (source,), schema), where=at("rowid", "a").is_not_null())
    return rows.where("concat('s_', rowid.a) <> rowid.b").select("rowid.a", "rowid.b", "price")


def orders_history(folder: str) -> VersionedTable:
    """Three versions of orders: each commit adds a year of data, the second adds columns."""
    source = scan_function("read_parquet", path_of(folder, "orders"))

    def version(label: str, columns: str, until: int, committed: dt.datetime) -> Version:
        names = T.StructType.fromDDL(columns).fieldNames()

        def rows(spark: SparkSession) -> DataFrame:
            return source.read(spark, None).where(f"NOT {since(until + 1)}").select(*names)

        table = Table("orders", (function_branch(rows),), T.StructType.fromDDL(columns))
        return Version(label, table, committed)

    key, price, status = "o_orderkey bigint", "o_totalprice double", "o_orderstatus string"
    return VersionedTable(
        "orders",
        (
            version("1.0.0", key, 1995, dt.datetime(1996, 1, 1)),
            version("1.1.0", f"{key}, {price}, {status}", 1996, dt.datetime(1997, 1, 1)),
            version("1.2.0", f"{key}, {price}", 1997, dt.datetime(1998, 1, 1)),
        ),
    )


@query(
    """
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE year(o_orderdate) <= 1996
    """
)
def asof_version(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, orders_history(folder), version="1.1.0")


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) <= 1995")
def asof_commit_time(spark: SparkSession, folder: str) -> DataFrame:
    moment = dt.datetime(1996, 12, 31, 23, 59, 59, 999_999)
    return scan(spark, orders_history(folder), as_of=moment)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) <= 1997")
def asof_default_version(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, orders_history(folder))


@query(
    """
    SELECT event_id, ts, user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00') WHERE rn = 1
    """
)
def asof_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    events = scan(
        spark,
        given(folder, "events"),
        columns=["event_id", "ts", "user_id", "event_type", "value"],
    )
    return latest_as_of(events, ["user_id"], "ts", dt.datetime(2024, 1, 15, 12), ["event_id"])


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_KEYS = ("l_orderkey", "l_partkey", "l_suppkey")


def _statistics_sql() -> str:
    def part(name: str, kind: str, bounds: str, length: str = "NULL") -> str:
        return (
            f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, "
            f"count(*) - count({name}) AS null_count, count(DISTINCT {name}) AS distinct_count, "
            f"{bounds}, CAST({length} AS BIGINT) AS max_length FROM lineitem"
        )

    text = "min({0}) AS min_text, max({0}) AS max_text"
    number = "CAST(min({0}) AS DOUBLE) AS min_number, CAST(max({0}) AS DOUBLE) AS max_number"
    no_text = "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
    no_number = "CAST(NULL AS DOUBLE) AS min_number, CAST(NULL AS DOUBLE) AS max_number"
    parts = [part(n, "bigint", f"{no_text}, {number.format(n)}") for n in _KEYS]
    parts.append(part("l_linenumber", "int", f"{no_text}, {number.format('l_linenumber')}"))
    parts += [part(n, "double", f"{no_text}, {number.format(n)}") for n in _NUMBERS]
    for name in ("l_returnflag", "l_linestatus"):
        parts.append(
            part(name, "string", f"{text.format(name)}, {no_number}", f"max(length({name}))")
        )
    parts.append(part("l_shipdate", "timestamp_ntz", f"{no_text}, {no_number}"))
    return " UNION ALL ".join(parts)


def _numbers_apart(statistics: DataFrame) -> DataFrame:
    """Text bounds and numeric bounds in columns of their own, so engines print them alike."""
    is_text = F.col("data_type") == "string"
    bound = lambda name: F.col(f"{name}_value")
    number = lambda name: F.when(~is_text, bound(name)).try_cast("double")
    return statistics.select(
        "column_name",
        "data_type",
        "row_count",
        "null_count",
        "distinct_count",
        *[F.when(is_text, bound(n)).alias(f"{n}_text") for n in ("min", "max")],
        *[number(n).alias(f"{n}_number") for n in ("min", "max")],
        "max_length",
    )


@query(_statistics_sql())
def column_statistics_exact(spark: SparkSession, folder: str) -> DataFrame:
    return _numbers_apart(column_statistics(scan(spark, given(folder, "lineitem"))))


@query(
    """
    SELECT 'priority' AS column_name, count(*) AS row_count, count(*) - count(p) AS null_count,
           count(DISTINCT p) AS distinct_count, min(p) AS min_value, max(p) AS max_value,
           CAST(max(length(p)) AS BIGINT) AS max_length
    FROM (SELECT NULLIF(o_orderpriority, '5-LOW') AS p FROM orders)
    UNION ALL SELECT 'nothing', count(*), count(*), 0, NULL, NULL, NULL FROM orders
    UNION ALL SELECT 'late', count(*), count(*) - count(o_orderdate),
                     count(DISTINCT year(o_orderdate) > 1998), NULL, NULL, NULL FROM orders
    """
)
def column_statistics_nulls(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.lit(None).cast("int").alias("nothing"),
        (F.year("o_orderdate") > 1998).alias("late"),
    )
    return column_statistics(orders).drop("data_type")


@query(
    """
    SELECT 'l_orderkey' AS column_name, count(*) AS row_count, TRUE AS close FROM lineitem
    UNION ALL SELECT 'l_partkey', count(*), TRUE FROM lineitem
    UNION ALL SELECT 'l_suppkey', count(*), TRUE FROM lineitem
    """
)
def column_statistics_approx(spark: SparkSession, folder: str) -> DataFrame:
    """The sketched distinct counts lie within a tenth of the exact ones."""
    lines = read(spark, folder, "lineitem")
    sketched = column_statistics(lines, _KEYS, distinct="approx")
    exact = column_statistics(lines, _KEYS).selectExpr("column_name", "distinct_count AS n")
    off = F.abs(F.col("distinct_count") - F.col("n"))
    return sketched.join(exact, "column_name").select(
        "column_name", "row_count", (off * 10 <= F.col("n")).alias("close")
    )


@query(
    """
    WITH late AS (SELECT * FROM lineitem WHERE year(l_shipdate) >= 1996)
    SELECT 'l_orderkey' AS column_name, count(*) AS row_count, count(*) - count(l_orderkey) AS null_count, TRUE AS close,
           CAST(min(l_orderkey) AS VARCHAR) AS min_value, CAST(max(l_orderkey) AS VARCHAR) AS max_value, CAST(NULL AS BIGINT) AS max_length FROM late
    UNION ALL SELECT 'l_partkey', count(*), count(*) - count(l_partkey), TRUE, CAST(min(l_partkey) AS VARCHAR), CAST(max(l_partkey) AS VARCHAR), NULL FROM late
    UNION ALL SELECT 'l_returnflag', count(*), count(*) - count(l_returnflag), TRUE, min(l_returnflag), max(l_returnflag), max(length(l_returnflag)) FROM late
    """
)
def stored_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by year: the last years came later and were read alone; what is asked for merges kept sketches of some years."""
    year = F.year("l_shipdate")
    lines = read(spark, folder, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_returnflag"]
    early = measured_parts(spark, lines.where(year < 1997), year, columns)
    whole = early.with_rows(spark, lines.where(year >= 1997), year)
    exact = column_statistics(lines.where(year >= 1996), columns).selectExpr("column_name", "distinct_count AS n")
    off = F.abs(F.col("distinct_count") - F.col("n"))
    return whole.table(F.col("part") >= "1996").join(exact, "column_name").select(
        "column_name", "row_count", "null_count", (off * 10 <= F.col("n")).alias("close"), "min_value", "max_value", "max_length"
    )


@query(
    """
    SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1998-02-01'
    GROUP BY o_orderstatus
    """
)
def branch_skipping(spark: SparkSession, folder: str) -> DataFrame:
    """A branch per year there is, with measured date ranges; only the years asked for are read."""
    source = scan_function("read_parquet", path_of(folder, "orders"))
    dates = source.read(spark, None).agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    span = range(dates[0], dates[1] + 1) if dates[0] is not None else ()
    years = tuple(source.filtered(f"{since(y)} AND NOT {since(y + 1)}") for y in span)
    rest = source.filtered("o_orderdate IS NULL")
    parts = Table("orders", (*years, rest), ORDERS, exclusive=True)
    table = profile_branches(spark, parts, [("o_orderdate",)])
    when = at("o_orderdate")
    rows = scan(
        spark, table, where=[when >= dt.datetime(1997, 3, 1), when < dt.datetime(1998, 2, 1)]
    )
    return rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderkey").alias("low"),
        F.max("o_orderkey").alias("high"),
    )


def boxes(spark: SparkSession, folder: str, required: tuple) -> Table:
    """Line items as boxes: a struct of four bounds and the order key."""
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey",
        F.struct(
            F.col("l_discount").alias("xmin"),
            F.col("l_tax").alias("ymin"),
            (F.col("l_discount") + F.col("l_quantity")).alias("xmax"),
            (F.col("l_tax") + F.col("l_linenumber")).alias("ymax"),
        ).alias("bbox"),
    )
    return Table("boxes", (frame_branch(lines),), lines.schema, required_filters=required)


@query(
    """
    SELECT l_orderkey, count(*) AS n FROM lineitem
    WHERE l_discount >= 0.02 AND l_tax >= 0.01 AND l_discount + l_quantity <= 20
      AND l_tax + l_linenumber <= 5 GROUP BY l_orderkey
    """
)
def required_filter_struct(spark: SparkSession, folder: str) -> DataFrame:
    required = tuple((("bbox", side),) for side in ("xmin", "ymin", "xmax", "ymax"))
    where = [
        at("bbox", "xmin") >= 0.02,
        at("bbox", "ymin") >= 0.01,
        at("bbox", "xmax") <= 20.0,
        at("bbox", "ymax") <= 5.0,
    ]
    rows = scan(spark, boxes(spark, folder, required), where=where)
    return rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_quantity <= 10 OR l_quantity > 40
    GROUP BY l_suppkey
    """
)
def required_filter_groups(spark: SparkSession, folder: str) -> DataFrame:
    """One of two columns must be filtered; an OR over one column counts as a filter on it."""
    source = scan_function("read_parquet", path_of(folder, "lineitem"))
    table = Table("lineitem", (source,), required_filters=((("l_shipdate",), ("l_quantity",)),))
    rows = scan(spark, table, where=(at("l_quantity") <= 10.0) | (at("l_quantity") > 40.0))
    return rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey = 2 AND c_acctbal > 0")
def struct_filter_deep(spark: SparkSession, folder: str) -> DataFrame:
    nested = read(spark, folder, "customer").select(
        "c_custkey",
        "c_acctbal",
        F.struct(F.struct(F.col("c_nationkey").alias("leaf")).alias("mid")).alias("wrapper"),
    )
    table = Table(
        "nested",
        (frame_branch(nested),),
        nested.schema,
        required_filters=((("wrapper", "mid", "leaf"),),),
    )
    where = [at("wrapper", "mid", "leaf") == 2, at("c_acctbal") > 0.0]
    return scan(spark, table, where=where, columns=["c_custkey", "c_acctbal"])


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND NOT (o_orderstatus = 'P')
      AND (o_orderpriority LIKE '1%' OR o_totalprice > 250000) AND o_orderkey > o_custkey
      AND o_orderdate IS NOT NULL AND o_orderstatus <> 'X'
    """
)
def filter_mix(spark: SparkSession, folder: str) -> DataFrame:
    where = [
        at("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"),
        ~(at("o_orderstatus") == "P"),
        at("o_orderpriority").startswith("1") | (at("o_totalprice") > 250000.0),
        at("o_orderkey") > at("o_custkey"),
        at("o_orderdate").is_not_null(),
        at("o_orderstatus") != "X",
    ]
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    return scan(spark, given(folder, "orders"), where=where, columns=columns)


@query(
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE event_type = 'click' AND value > 10 OR event_type = 'error'
    """
)
def filter_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """NULL tests over columns that do hold NULLs: clicks have no type, errors no value."""
    kind = F.nullif("event_type", F.lit("click"))
    value = F.when(F.col("event_type") != "error", F.col("value"))
    events = read(spark, folder, "events").select(
        "event_id", "user_id", kind.alias("kind"), value.alias("value")
    )
    table = Table("events", (frame_branch(events),), events.schema)
    clicks = at("kind").is_null() & (at("value") > 10.0) & at("user_id").is_not_null()
    rows = scan(spark, table, where=clicks | at("value").is_null())
    return rows.select(
        "event_id", "user_id", F.coalesce("kind", F.lit("click")).alias("event_type")
    )


@query(
    """
    SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey
    """
)
def required_filter_parent(spark: SparkSession, folder: str) -> DataFrame:
    """A filter on a struct counts for a required path inside it."""
    returned = F.col("l_returnflag") == "R"
    inner = F.when(returned, F.struct(F.col("l_shipdate").alias("leaf")))
    lines = read(spark, folder, "lineitem").select(inner.alias("wrapper"), "l_suppkey")
    table = Table(
        "lines", (frame_branch(lines),), lines.schema, required_filters=((("wrapper", "leaf"),),)
    )
    rows = scan(spark, table, where=at("wrapper").is_not_null())
    return rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT c_mktsegment, count(*) AS n_orders, max(o_totalprice) AS largest
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY c_mktsegment
    """
)
def catalog_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of a catalog offered to SQL; the guarded one brings its filter along."""
    catalog = Catalog("given", default_namespace=("data",))
    catalog.add(given(folder, "customer"))
    catalog.add(orders_by_status(folder))
    customers = catalog.publish(spark, "customer", view="tablespan_customer")
    recent = catalog.publish(
        spark,
        "orders",
        view="tablespan_recent_orders",
        where=at("o_orderdate") >= dt.datetime(1999, 1, 1),
    )
    return spark.sql(
        f"""SELECT c_mktsegment, count(*) AS n_orders, max(o_totalprice) AS largest
        FROM {recent} JOIN {customers} ON o_custkey = c_custkey GROUP BY c_mktsegment"""
    )
