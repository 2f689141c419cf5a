"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.sources.shared import kept_and_measured

MOST_ROUNDS = 60


def _stars(links: DataFrame, own: str, other: str) -> DataFrame:
    """Each link with the smallest of its node's neighbours and the node itself.

    The smallest is an aggregate that combines before its shuffle; joining it back moves narrow rows, and
    a node that most links have is split by the adaptive skew join.
    """
    least = links.groupBy(own).agg(F.min(other).alias("least"))
    return links.join(least, own).select(own, other, F.least(F.col(own), F.col("least")).alias("least"))


def _ways(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(a, b) of each pair of columns of each row; a union would plan and read the rows once for each pair."""
    return rows.select(F.inline(F.array(*(F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs))))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label) of all nodes with a link; the label is the component's smallest node.

    `links`: (a, b), in any order; repeated links and loops do no harm.
    """
    whole = (F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))  # links that are stars already settle in one round
    edges, before = kept_and_measured(spark, links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), *whole)
    for _ in range(MOST_ROUNDS):
        both = _ways(edges, ("a", "b"), ("b", "a"))
        large = _stars(both, "a", "b").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = _stars(large.distinct(), "a", "b")
        moved = _ways(small, ("b", "least"), ("a", "least"))
        edges, now = kept_and_measured(spark, moved.filter("a <> b").distinct(), *whole)
        if now == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(roots)
        before = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
