"""Relational operators Spark brings itself, over scanned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablespan.operators.asof import join_as_of as as_of
from tablespan.operators.intervals import join_overlaps
from tablespan.queries.registry import query, read


@query(
    """
    WITH ranked AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (
                      PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    SELECT a.o_custkey, a.o_orderkey AS best, b.o_orderkey AS second
    FROM ranked a JOIN ranked b ON a.o_custkey = b.o_custkey AND a.rn = 1 AND b.rn = 2
    WHERE a.o_totalprice > (SELECT 2 * avg(CAST(c.o_totalprice AS DECIMAL(18,2)))
                            FROM orders c WHERE c.o_custkey = a.o_custkey)
    """
)
def window_self_join(spark: SparkSession, folder: str) -> DataFrame:
    """Best and second order of customers whose best is twice their average.

    The rank limit is applied inside each task before the rows of a customer
    meet, so a customer with very many orders sends only two per task.
    """
    orders = read(spark, folder, "orders")
    by_price = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    best = orders.select(
        "o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(by_price).alias("rn")
    ).where("rn <= 2")
    # Two rows per customer are left, which one grouping turns into one.
    pairs = best.groupBy("o_custkey").agg(
        F.max(F.when(F.col("rn") == 1, F.col("o_orderkey"))).alias("best"),
        F.max(F.when(F.col("rn") == 2, F.col("o_orderkey"))).alias("second"),
        F.max(F.when(F.col("rn") == 1, F.col("o_totalprice"))).alias("price"),
    )
    means = orders.groupBy("o_custkey").agg(
        F.avg(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("mean")
    )
    return (
        pairs.where(F.col("second").isNotNull())
        .join(means, "o_custkey")
        .where("price > 2 * mean")
        .select("o_custkey", "best", "second")
    )


@query(
    """
    WITH low AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal < 0),
    full_outer AS (
      SELECT coalesce(l.c_nationkey, s.s_nationkey) AS nation, l.c_custkey, s.s_suppkey
      FROM low l FULL JOIN supplier s ON l.c_nationkey = s.s_nationkey)
    SELECT 'full' AS kind, CAST(nation AS BIGINT) AS k, count(c_custkey) AS a, count(s_suppkey) AS b
    FROM full_outer GROUP BY nation
    UNION ALL
    SELECT 'semi', CAST(s_nationkey AS BIGINT), count(*), 0 FROM supplier
    WHERE s_nationkey IN (SELECT c_nationkey FROM low) GROUP BY s_nationkey
    UNION ALL
    SELECT 'range', o_custkey, count(*), CAST(sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS BIGINT)
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
     AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 30 DAY GROUP BY o_custkey
    """
)
def join_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Full, semi and range joins; each has an equality that its rows are dealt by."""
    low = read(spark, folder, "customer").where("c_acctbal < 0").select("c_custkey", "c_nationkey")
    suppliers = read(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    same = low["c_nationkey"] == suppliers["s_nationkey"]
    full = low.join(suppliers, same, "full").groupBy(
        F.coalesce("c_nationkey", "s_nationkey").cast("bigint").alias("k")
    ).agg(F.count("c_custkey").alias("a"), F.count("s_suppkey").alias("b"))
    semi = suppliers.join(low, same, "left_semi").groupBy(F.col("s_nationkey").cast("bigint").alias("k")).agg(
        F.count(F.lit(1)).alias("a"), F.lit(0).cast("bigint").alias("b")
    )
    orders, lines = read(spark, folder, "orders"), read(spark, folder, "lineitem")
    soon = (
        (orders["o_orderkey"] == lines["l_orderkey"])
        & (lines["l_shipdate"] >= orders["o_orderdate"])
        & (lines["l_shipdate"] < orders["o_orderdate"] + F.expr("INTERVAL 30 DAYS"))
    )
    ranged = orders.join(lines, soon).groupBy(F.col("o_custkey").alias("k")).agg(
        F.count(F.lit(1)).alias("a"), F.count_if(F.col("l_quantity") > 25).alias("b")
    )
    kinds = {"full": full, "semi": semi, "range": ranged}
    first, *others = [f.select(F.lit(kind).alias("kind"), "k", "a", "b") for kind, f in kinds.items()]
    for other in others:
        first = first.union(other)
    return first


@query(
    """
    WITH last AS (
      SELECT o.o_orderkey, max(e.ts) AS ts FROM (SELECT o_orderkey, o_custkey,
             o_orderdate + INTERVAL 10000 DAY AS moment FROM orders) o
      JOIN events e ON e.user_id = o.o_custkey AND e.ts <= o.moment GROUP BY o.o_orderkey)
    SELECT o_orderkey, ts AS last_event FROM orders LEFT JOIN last USING (o_orderkey)
    """
)
def join_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Each order's last event of its customer up to a moment."""
    moment = F.col("o_orderdate") + F.expr("INTERVAL 10000 DAYS")
    orders = read(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), moment.alias("at"))
    events = read(spark, folder, "events").select("user_id", "ts", F.col("ts").alias("last_event"))
    return as_of(orders, events, ["user_id"], "at", "ts", ["last_event"]).select("o_orderkey", "last_event")


@query(
    """
    WITH bought AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase')
    SELECT e.event_id, max(p.event_id) AS purchase, arg_max(p.value, {'t': p.ts, 'i': p.event_id}) AS paid
    FROM events e JOIN bought p ON p.user_id = e.user_id AND p.ts < e.ts AND p.ts >= e.ts - INTERVAL 3 DAY
     AND NOT EXISTS (SELECT 1 FROM bought q WHERE q.user_id = e.user_id AND q.ts < e.ts AND q.ts > p.ts)
    WHERE e.event_type = 'error' GROUP BY e.event_id
    """
)
def join_as_of_before(spark: SparkSession, folder: str) -> DataFrame:
    """The last purchase strictly before each error, if it is at most three days old; the greater id decides a tie."""
    events = read(spark, folder, "events")
    bought = events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("bought"), F.col("event_id").alias("purchase"), F.col("value").alias("paid")
    )
    errors = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    days = F.expr("INTERVAL 3 DAYS")
    found = as_of(errors, bought, ["user_id"], "ts", "bought", ["purchase", "paid"], ["purchase"], before=True, within=days, how="inner")
    return found.select("event_id", "purchase", "paid")


@query(
    """
    SELECT o_orderkey, count(*) AS n_lines, CAST(sum(l_linenumber) AS BIGINT) AS numbers
    FROM orders JOIN lineitem ON l_shipdate <= o_orderdate + INTERVAL 3 DAY
     AND l_shipdate + to_days(CAST(l_quantity AS INTEGER)) >= o_orderdate
    WHERE o_totalprice > 499500 AND l_returnflag = 'R' GROUP BY o_orderkey
    """
)
def join_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Returned lines under way while a dear order is in its first three days: no equality, only overlap."""
    dear = read(spark, folder, "orders").where("o_totalprice > 499500").select(
        "o_orderkey", "o_orderdate", (F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")).alias("until")
    )
    arrival = F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int"))
    lines = read(spark, folder, "lineitem").where("l_returnflag = 'R'").select("l_linenumber", "l_shipdate", arrival.alias("arrival"))
    pairs = join_overlaps(dear, lines, ("o_orderdate", "until"), ("l_shipdate", "arrival"))
    return pairs.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_linenumber").cast("bigint")).alias("numbers")
    )


@query(
    """
    SELECT l_suppkey, count(*) AS n FROM lineitem l
    WHERE l_quantity > (SELECT 1.5 * avg(p.l_quantity) FROM lineitem p WHERE p.l_partkey = l.l_partkey)
    GROUP BY l_suppkey
    """
)
def correlated_subquery(spark: SparkSession, folder: str) -> DataFrame:
    """A scalar subquery that names the outer row; Spark turns it into a join."""
    read(spark, folder, "lineitem").createOrReplaceTempView("tablespan_lines")
    return spark.sql(
        """SELECT l_suppkey, count(*) AS n FROM tablespan_lines l
        WHERE l_quantity > (SELECT 1.5 * avg(p.l_quantity) FROM tablespan_lines p
                            WHERE p.l_partkey = l.l_partkey) GROUP BY l_suppkey"""
    )


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100
    """
)
def topk(spark: SparkSession, folder: str) -> DataFrame:
    ordered = read(spark, folder, "orders").orderBy(
        F.desc_nulls_last("o_totalprice"), "o_orderkey"
    )
    return ordered.select("o_orderkey", "o_totalprice").limit(100)


@query(
    """
    (SELECT o_custkey AS k, 'either' AS kind FROM orders UNION SELECT c_custkey, 'either' FROM customer)
    UNION ALL (SELECT k, 'both' FROM (SELECT o_custkey AS k FROM orders INTERSECT
                                      SELECT c_custkey FROM customer))
    UNION ALL (SELECT k, 'idle' FROM (SELECT c_custkey AS k FROM customer EXCEPT
                                      SELECT o_custkey FROM orders))
    """
)
def set_ops(spark: SparkSession, folder: str) -> DataFrame:
    ordering = read(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    known = read(spark, folder, "customer").select(F.col("c_custkey").alias("k"))

    def kind(frame: DataFrame, name: str) -> DataFrame:
        return frame.withColumn("kind", F.lit(name))

    either = kind(ordering.union(known).distinct(), "either")
    both = kind(ordering.intersect(known), "both")
    return either.union(both).union(kind(known.subtract(ordering), "idle"))


@query(
    """
    SELECT n_name, count(*) AS n_orders, count(DISTINCT c_custkey) AS n_customers,
           CAST(sum(CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                                      AND l.l_returnflag = 'R') THEN 1 ELSE 0 END) AS BIGINT) AS n_returned
    FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_tax > 0.07)
    GROUP BY n_name
    """
)
def joins(spark: SparkSession, folder: str) -> DataFrame:
    """Inner, left, anti and existence joins in one report; Spark picks the strategies."""
    orders = read(spark, folder, "orders")
    lines = read(spark, folder, "lineitem")
    customers = read(spark, folder, "customer")
    nations = read(spark, folder, "nation")
    taxed = lines.where("l_tax > 0.07").select(F.col("l_orderkey").alias("o_orderkey"))
    returned = (
        lines.where("l_returnflag = 'R'")
        .select(F.col("l_orderkey").alias("o_orderkey"))
        .distinct()
        .withColumn("returned", F.lit(1))
    )
    kept = orders.join(taxed, "o_orderkey", "left_anti").join(returned, "o_orderkey", "left")
    named = kept.join(customers, kept["o_custkey"] == customers["c_custkey"]).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return named.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_distinct("c_custkey").alias("n_customers"),
        F.coalesce(F.sum("returned"), F.lit(0)).cast("bigint").alias("n_returned"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, unnest(range(1, l_linenumber + 1))::INTEGER AS step
    FROM lineitem
    """
)
def explode_sequence(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    steps = F.explode(F.sequence(F.lit(1), F.col("l_linenumber")))
    return lines.select("l_orderkey", "l_linenumber", steps.alias("step"))


@query(
    """
    SELECT o_orderkey, weight FROM orders
    JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3)) AS w(priority, weight)
      ON o_orderpriority = priority
    """
)
def inline_values(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """
        SELECT o_orderkey, weight FROM {orders}
        JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3)) AS w(priority, weight)
          ON o_orderpriority = priority
        """,
        orders=read(spark, folder, "orders"),
    )
