"""Counting sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def sequence(spark: SparkSession, n: int) -> DataFrame:
    """0 … n-1 as column ``n``, in as many tasks as the session's default."""
    return spark.range(n).toDF("n")


def split_sequence(spark: SparkSession, n: int, splits: int = 4) -> DataFrame:
    """The rows of :func:`sequence` made by exactly ``splits`` tasks."""
    if splits < 1:
        raise ValueError("split_sequence needs at least one split")
    return spark.range(0, n, 1, splits).toDF("n")


def range_of(n: Column, total: int, splits: int) -> Column:
    """Which of ``splits`` contiguous ranges of 0 … total-1 holds ``n``.

    Ranges differ in size by at most one and the longer ones come first.
    """
    size, longer = divmod(total, splits)
    border = longer * (size + 1)
    in_longer = F.call_function("div", n, F.lit(size + 1))
    if size == 0:
        return in_longer
    in_shorter = F.call_function("div", n - F.lit(border), F.lit(size)) + F.lit(longer)
    return F.when(n < F.lit(border), in_longer).otherwise(in_shorter)
