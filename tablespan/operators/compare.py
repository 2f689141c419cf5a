"""Compare two results as multisets of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.schema import quoted

# How a compared cell shows a NULL and an empty text.
NULL_TEXT = "NULL"
EMPTY_TEXT = "(empty)"


def frames_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``side`` and the number of ``copies``.

    ``missing`` rows are expected and not there, ``extra`` rows are there and not
    expected.  Both frames are counted in one shuffle, and equal rows meet within
    each task first, so many copies of one row cost no more than one.  Copies are
    reported as a count and not written out.
    """
    if actual.columns != expected.columns:
        raise ValueError(f"columns differ: {actual.columns} and {expected.columns}")
    for a, e in zip(actual.schema.fields, expected.schema.fields):
        if a.dataType.simpleString() != e.dataType.simpleString():
            raise ValueError(
                f"column '{a.name}' is {a.dataType.simpleString()} in the actual frame and "
                f"{e.dataType.simpleString()} in the expected one"
            )
    taken = [n for n in ("side", "copies") if n in actual.columns]
    if taken:
        raise ValueError(f"columns named {taken} clash with the report's own")
    signed = actual.withColumn("copies", F.lit(1).cast("bigint")).union(
        expected.withColumn("copies", F.lit(-1).cast("bigint"))
    )
    counted = signed.groupBy(*[F.col(quoted(c)) for c in actual.columns]).agg(
        F.sum("copies").alias("copies")
    )
    side = F.when(F.col("copies") > 0, F.lit("extra")).otherwise(F.lit("missing"))
    return counted.where("copies <> 0").select(
        side.alias("side"),
        *[F.col(quoted(c)) for c in actual.columns],
        F.abs("copies").alias("copies"),
    )


def as_text(frame: DataFrame) -> DataFrame:
    """Every cell as text, with NULL and empty text spelled out, for comparing across types."""
    return frame.select(*[shown(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in frame.schema.fields])


def shown(cell: Column, kind: T.DataType) -> Column:
    """One cell as text."""
    text = F.hex(cell) if isinstance(kind, T.BinaryType) else cell.cast("string")
    return F.coalesce(F.when(text == F.lit(""), F.lit(EMPTY_TEXT)).otherwise(text), F.lit(NULL_TEXT))
