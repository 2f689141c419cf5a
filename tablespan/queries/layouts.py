"""Layout and comparison."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.operators.compare import as_text, frames_diff
from tablespan.operators.digests import cells_differ, digests, rows_differ
from tablespan.operators.layout import key_grouped, store_key_grouped
from tablespan.queries.registry import kept, new_folder, query, read


@query(
    """
    WITH fine AS (SELECT l_suppkey, l_returnflag, count(*) AS n, max(l_shipdate) AS last_ship
                  FROM lineitem GROUP BY l_suppkey, l_returnflag)
    SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_flags,
           max(last_ship) AS last_ship FROM fine GROUP BY l_suppkey
    """
)
def key_grouped_agg(spark: SparkSession, folder: str) -> DataFrame:
    """Combined first, then laid out by supplier; the second grouping needs no exchange."""
    fine = (
        read(spark, folder, "lineitem")
        .groupBy("l_suppkey", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("last_ship"))
    )
    laid = key_grouped(fine, ["l_suppkey"])
    return laid.groupBy("l_suppkey").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("n_flags"),
        F.max("last_ship").alias("last_ship"),
    )


_DIFF_SQL = """
    WITH actual AS (
      SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW'
      UNION ALL
      SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH'),
    expected AS (
      SELECT o_orderkey, CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderstatus END
             AS o_orderstatus, o_totalprice FROM orders)
"""


@query(
    _DIFF_SQL
    + """
    SELECT 'extra' AS side, *, count(*) AS copies
    FROM (SELECT * FROM actual EXCEPT ALL SELECT * FROM expected) GROUP BY ALL
    UNION ALL
    SELECT 'missing' AS side, *, count(*) AS copies
    FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM actual) GROUP BY ALL
    """
)
def diff_of_frames(spark: SparkSession, folder: str) -> DataFrame:
    """One copy lacks rows and repeats others, the other has NULLs instead of values."""
    actual, expected = _altered(read(spark, folder, "orders"))
    return frames_diff(actual, expected)


def _altered(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    priority = F.col("o_orderpriority")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    actual = orders.where(priority != "5-LOW").union(orders.where(priority == "2-HIGH"))
    status = F.when(priority != "3-MEDIUM", F.col("o_orderstatus"))
    return actual.select(*columns), orders.withColumn("o_orderstatus", status).select(*columns)


@query(
    """
    SELECT o_orderkey::VARCHAR AS key, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'NULL'
           WHEN '4-NOT SPECIFIED' THEN '(empty)' ELSE o_orderstatus END AS status FROM orders
    """
)
def diff_text_cells(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    status = F.when(priority == "4-NOT SPECIFIED", "").when(
        priority != "3-MEDIUM", F.col("o_orderstatus")
    )
    rows = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"), status.alias("status")
    )
    return as_text(rows)


@query(
    """
    WITH changed AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 103 <> 0 THEN o_orderstatus END AS o_orderstatus,
             CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END AS o_totalprice,
             o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
    marked AS (SELECT *, o_orderkey % 101 = 0 OR (o_orderkey % 103 = 0 AND status IS NOT NULL) AS altered FROM changed)
    SELECT o_orderkey, 'o_orderstatus' AS column_name, 'NULL' AS actual, status AS expected,
           CAST(1 AS BIGINT) AS extra, CAST(1 AS BIGINT) AS missing
    FROM marked WHERE o_orderkey % 103 = 0 AND status IS NOT NULL AND o_orderkey % 211 <> 0 AND o_orderkey % 307 <> 0
    UNION ALL
    SELECT o_orderkey, 'o_totalprice', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), CAST(price AS VARCHAR), 1, 1
    FROM marked WHERE o_orderkey % 101 = 0 AND o_orderkey % 211 <> 0 AND o_orderkey % 307 <> 0
    UNION ALL
    SELECT o_orderkey, NULL, NULL, NULL, 0, 1 FROM marked WHERE o_orderkey % 211 = 0
    UNION ALL
    SELECT o_orderkey, NULL, NULL, NULL, CASE WHEN altered THEN 2 ELSE 1 END, CASE WHEN altered THEN 1 ELSE 0 END
    FROM marked WHERE o_orderkey % 307 = 0 AND o_orderkey % 211 <> 0
    """
)
def diff_by_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with kept digests against a copy with some changed, dropped and repeated rows: the cells that differ."""
    price, number = F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderkey")
    expected = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus", price.alias("o_totalprice"))
    changed = expected.where(number % 211 != 0).withColumns(
        {
            "o_orderstatus": F.when(number % 103 != 0, F.col("o_orderstatus")),
            "o_totalprice": (F.col("o_totalprice") + F.when(number % 101 == 0, 1).otherwise(0)).cast("decimal(18,2)"),
        }
    )
    actual = changed.union(changed.where(number % 307 == 0))
    key = ["o_orderkey"]
    known = kept(spark, digests(expected, key))
    return cells_differ(rows_differ(actual, expected, key, expected_digests=known), key)


@query(
    """
    SELECT l_suppkey, count(*) AS n_parts, CAST(sum(n) AS BIGINT) AS n, CAST(max(n) AS BIGINT) AS most
    FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_suppkey
    """
)
def key_grouped_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by supplier and part, stored in buckets of suppliers; grouping the stored table needs no exchange."""
    fine = read(spark, folder, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    stored = store_key_grouped(fine, f"supplied_{uuid4().hex}", ["l_suppkey"], 16, new_folder(spark))
    return stored.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum("n").alias("n"), F.max("n").alias("most")
    )
