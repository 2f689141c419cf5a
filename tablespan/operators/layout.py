"""Where rows live: grouped by key, in a frame or in a stored table.

A layout never changes a result.  It gathers the rows of a key in one task, so
a caller can have keys that hold too large a share of the rows refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespan.operators.schema import quoted


# A key is a column name, or the path to a field inside a struct column.
Key = str | tuple[str, ...]


def _columns(keys: Sequence[Key]) -> list[Column]:
    paths = [(key,) if isinstance(key, str) else key for key in keys]
    return [F.col(".".join(quoted(part) for part in path)) for path in paths]


def largest_share(frame: DataFrame, keys: Sequence[Key]) -> float:
    """The share of rows held by the most frequent key; 0 for an empty frame.

    Counts are combined before the shuffle and one row reaches the driver.
    """
    counts = frame.groupBy(*_columns(keys)).agg(F.count(F.lit(1)).alias("rows"))
    top = counts.agg(F.max("rows").alias("top"), F.sum("rows").alias("rows")).first()
    return (top["top"] or 0) / top["rows"] if top["rows"] else 0.0


def key_grouped(
    frame: DataFrame,
    keys: Sequence[Key],
    partitions: int | None = None,
    most_share: float | None = None,
) -> DataFrame:
    """Place rows so that grouping or joining by ``keys`` needs no further exchange.

    Meant for work that needs the rows of a key side by side.  An ordinary
    aggregate should group the raw frame: Spark then combines before it
    shuffles.  Without ``partitions`` the session decides how many there are.
    ``most_share`` is the largest share of rows that one key may hold: the share
    is measured, which reads the key columns once, and a larger one is refused.
    """
    refuse_uneven(frame, keys, most_share)
    columns = _columns(keys)
    return frame.repartition(*([partitions] if partitions else []), *columns)


def store_key_grouped(
    frame: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    path: str | None = None,
    most_share: float | None = None,
) -> DataFrame:
    """Write ``frame`` once in buckets of ``keys``; later groupings and joins need no exchange.

    A bucket is read by one task, so uneven keys are refused as by :func:`key_grouped`.
    """
    refuse_uneven(frame, keys, most_share)
    writer = frame.repartition(buckets, *_columns(keys)).write.format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return frame.sparkSession.table(table)


def refuse_uneven(frame: DataFrame, keys: Sequence[Key], most_share: float | None) -> None:
    """Raise if a key holds more than ``most_share`` of the rows; ``None`` measures nothing."""
    if most_share is None:
        return
    share = largest_share(frame, keys)
    if share > most_share:
        raise ValueError(
            f"one key of {list(keys)} holds {share:.1%} of the rows, more than {most_share:.1%}"
        )
