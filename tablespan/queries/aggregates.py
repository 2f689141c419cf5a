"""Aggregates: native ones, and user-defined ones with a mergeable state."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.operators.aggregates import user_aggregate
from tablespan.queries.registry import query, read


@query(
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS total,
           count(*) AS n, avg(l_linenumber) AS mean, count(DISTINCT l_suppkey) AS suppliers,
           min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def agg_sum_count_avg(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_linenumber").alias("total"),
            F.count(F.lit(1)).alias("n"),
            F.avg("l_linenumber").alias("mean"),
            F.count_distinct("l_suppkey").alias("suppliers"),
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )


@query(
    """
    SELECT CAST(sum(l_orderkey) AS BIGINT) AS total, count(*) AS n,
           CAST(sum(NULLIF(l_suppkey, 3)) AS BIGINT) AS without_three,
           CAST(sum(CASE WHEN l_suppkey < 0 THEN 1 END) AS BIGINT) AS of_nothing FROM lineitem
    """
)
def agg_ungrouped(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").agg(
        F.sum("l_orderkey").alias("total"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.nullif("l_suppkey", F.lit(3))).alias("without_three"),
        F.sum(F.when(F.col("l_suppkey") < 0, 1)).alias("of_nothing"),
    )


@query(
    """
    SELECT l_orderkey, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total,
           max(l_quantity) AS largest FROM lineitem GROUP BY l_orderkey
    """
)
def agg_high_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_linenumber").alias("total"),
            F.max("l_quantity").alias("largest"),
        )
    )


@query(
    """
    SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS kinds
    FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id
    """
)
def agg_listagg(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's kinds of event; duplicates fall away before anything is gathered."""
    kinds = read(spark, folder, "events").select("user_id", "event_type").distinct()
    listed = F.expr("listagg(event_type, ',') WITHIN GROUP (ORDER BY event_type)")
    return kinds.groupBy("user_id").agg(listed.alias("kinds"))


class CommonDivisor:
    """The greatest common divisor of a group's integers; NULLs do not count."""

    state = "divisor bigint"
    result = "bigint"

    def start(self, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"divisor": rows.iloc[:, 0].fillna(0).astype("int64")})

    def combine(self, groups) -> pd.DataFrame:
        # Sorted by group, each group is one slice for numpy.
        codes = groups.ngroup().to_numpy()
        values = groups.obj["divisor"].to_numpy(dtype="int64")
        order = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
        divisors = np.gcd.reduceat(values[order], starts)
        return groups.first().assign(divisor=divisors)

    def finish(self, states: pd.DataFrame) -> pd.Series:
        return states["divisor"].astype("int64[pyarrow]")

    def empty(self) -> tuple:
        return (0,)


@query(
    """
    SELECT l_shipdate, coalesce(list_reduce(list(q) FILTER (q IS NOT NULL),
           lambda a, b: gcd(a, b)), 0) AS divisor
    FROM (SELECT l_shipdate, CASE WHEN l_linestatus = 'F' THEN NULL
                 ELSE CAST(l_quantity AS BIGINT) END AS q FROM lineitem) GROUP BY l_shipdate
    """
)
def agg_user_grouped(spark: SparkSession, folder: str) -> DataFrame:
    """An aggregate Spark lacks, over groups that hold NULLs."""
    value = F.when(F.col("l_linestatus") != "F", F.col("l_quantity").cast("bigint"))
    lines = read(spark, folder, "lineitem").select("l_shipdate", value.alias("q"))
    return user_aggregate(lines, ["l_shipdate"], CommonDivisor(), ["q"], "divisor")


@query(
    """
    SELECT l_orderkey, list_reduce(list(l_partkey), lambda a, b: gcd(a, b)) AS divisor
    FROM lineitem GROUP BY l_orderkey
    """
)
def agg_user_many_groups(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    return user_aggregate(lines, ["l_orderkey"], CommonDivisor(), ["l_partkey"], "divisor")


@query("SELECT CAST(0 AS BIGINT) AS divisor FROM lineitem WHERE l_quantity < 0 HAVING count(*) = 0")
def agg_user_empty(spark: SparkSession, folder: str) -> DataFrame:
    nothing = read(spark, folder, "lineitem").where("l_quantity < 0")
    return user_aggregate(nothing, [], CommonDivisor(), ["l_partkey"], "divisor")


@query("SELECT list_reduce(list(user_id * 30), lambda a, b: gcd(a, b)) AS divisor FROM events")
def agg_user_ungrouped(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events").select((F.col("user_id") * 30).alias("v"))
    return user_aggregate(events, [], CommonDivisor(), ["v"], "divisor")


@query(
    """
    SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(grouping(o_orderstatus, o_orderpriority, year(o_orderdate)) AS BIGINT) AS level,
           count(*) AS n, max(o_totalprice) AS largest
    FROM orders GROUP BY GROUPING SETS (
      (o_orderstatus, o_orderpriority), (o_orderstatus, year(o_orderdate)), (o_orderpriority), ())
    """
)
def agg_grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Totals on several levels of detail from one scan."""
    orders = read(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    status, priority, year = (F.col(c) for c in ("o_orderstatus", "o_orderpriority", "year"))
    levels = [[status, priority], [status, year], [priority], []]
    return orders.groupingSets(levels, status, priority, year).agg(
        F.grouping_id("o_orderstatus", "o_orderpriority", "year").cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("n"),
        F.max("o_totalprice").alias("largest"),
    )
