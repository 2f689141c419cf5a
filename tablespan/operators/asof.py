"""Row-level time travel: the newest row of each key at a moment, or at each row's own moment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.schema import quoted
from tablespan.plans.predicates import at


def latest_as_of(
    frame: DataFrame,
    keys: Sequence[str],
    time: str,
    moment: dt.datetime,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Per key the row with the greatest ``time`` not after ``moment``.

    Written as an aggregate, not a window: each task first reduces its own rows
    to one per key, so a key that holds much of the table is never gathered.
    Rows that tie on ``time`` are decided by the greatest ``tie_break``; columns
    that identify a row make the result unique.
    """
    if not keys:
        raise ValueError("latest_as_of needs at least one key")
    before = frame.where((at(time) <= moment).column(frame.schema))
    rank = F.struct(*[F.col(quoted(c)) for c in (time, *tie_break)])
    rest = [c for c in frame.columns if c not in keys]
    row = F.struct(*[F.col(quoted(c)) for c in rest])
    newest = before.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.max_by(row, rank).alias("row"))
    picked = {c: F.col("row").getField(c).alias(c) for c in rest}
    return newest.select(*[picked.get(c, F.col(quoted(c))) for c in frame.columns])


#: How many slices of time the rows of one key are dealt to.
SLICES = 32


def join_as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    take: Sequence[str],
    tie_break: Sequence[str] = (),
    before: bool = False,
    within: Column | None = None,
    how: str = "left",
    slices: int = SLICES,
) -> DataFrame:
    """Each left row with the columns ``take`` of the last right row of its keys up to its time.

    Rows are dealt by key and slice of time, whose borders are sketched quantiles of
    the right times, so a key with much of the table is spread over ``slices`` tasks.
    What a slice takes over from earlier ones is found from one row per key and
    slice.  Right rows that tie on time are decided by the greatest ``tie_break``.
    ``before`` asks for an earlier time, not an equal one; ``within`` is how much
    earlier it may be (an interval or a number).  A NULL key or time matches nothing;
    such left rows have NULLs with ``how="left"`` and go with ``"inner"``.
    """
    if not keys:
        raise ValueError("join_as_of needs at least one key")
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if slices < 1:
        raise ValueError("join_as_of needs at least one slice")
    kinds = [f.schema[t].dataType for f, t in ((left, left_time), (right, right_time))]
    if kinds[0] != kinds[1]:
        raise TypeError(f"times differ: {kinds[0].simpleString()} and {kinds[1].simpleString()}")
    taken = [c for c in take if c in left.columns]
    if taken:
        raise ValueError(f"columns {taken} are in the left rows already")
    names = [f"key_{i}" for i in range(len(keys))]
    own = [F.col(quoted(k)).alias(n) for k, n in zip(keys, names)]
    usable = [F.col(quoted(k)).isNotNull() for k in keys]
    borders = _borders(right, right_time, slices)

    found = F.struct(F.col(quoted(right_time)).alias("time"), *[F.col(quoted(c)).alias(f"take_{i}") for i, c in enumerate(take)])
    rank = F.struct(F.lit(0), *[F.col(quoted(c)) for c in tie_break])
    rights = right.where(reduce(Column.__and__, [*usable, F.col(quoted(right_time)).isNotNull()])).select(
        *own, F.col(quoted(right_time)).alias("time"), found.alias("found"), rank.alias("rank")
    )
    rights = rights.withColumn("slice", _slice(F.col("time"), borders, kinds[1]))
    row = F.struct(*[F.col(quoted(c)) for c in left.columns])
    lefts = left.select(*own, F.col(quoted(left_time)).alias("time"), row.alias("row"))
    dealt = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*names, "time")])
    lone = lefts.where(~dealt).select("row", F.lit(None).cast(rights.schema["found"].dataType).alias("last"))
    lefts = lefts.where(dealt).withColumn("slice", _slice(F.col("time"), borders, kinds[0]))

    # What stands at the end of each slice, and which slices have left rows: a row each for a key and slice.
    ends = rights.groupBy(*names, "slice").agg(F.max_by("found", F.struct("time", "rank")).alias("found"))
    asked = lefts.select(*names, "slice").distinct()
    along = Window.partitionBy(*names).orderBy("slice", F.col("found").isNotNull())
    earlier = F.last("found", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    carried = (
        ends.unionByName(asked, allowMissingColumns=True)
        .select(*names, "slice", F.col("found").isNull().alias("asked"), earlier.alias("found"))
        .where("asked AND found IS NOT NULL")
    )

    rows = (
        lefts.withColumn("side", F.lit(1 if before else 2))
        .unionByName(rights.withColumn("side", F.lit(2 if before else 1)), allowMissingColumns=True)
        .unionByName(carried.drop("asked").withColumn("side", F.lit(0)), allowMissingColumns=True)
    )
    by_time = Window.partitionBy(*names, "slice").orderBy(F.col("time").asc_nulls_first(), "side", F.col("rank").asc_nulls_first())
    last = F.last("found", ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    matched = rows.select("row", last.alias("last")).where("row IS NOT NULL").unionByName(lone)
    if within is not None:
        time = F.col("row").getField(left_time)
        matched = matched.withColumn("last", F.when(F.col("last.time") >= time - within, F.col("last")))
    if how == "inner":
        matched = matched.where("last IS NOT NULL")
    return matched.select(
        *[F.col("row").getField(c).alias(c) for c in left.columns],
        *[F.col("last").getField(f"take_{i}").alias(c) for i, c in enumerate(take)],
    )


def _borders(frame: DataFrame, time: str, slices: int) -> list[str]:
    """The times at which slices begin, as text; one sketch of bounded size is made of all rows."""
    if slices == 1:
        return []
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    sketch = F.percentile_approx(F.col(quoted(time)), shares, 1000)
    found = frame.agg(sketch.cast("array<string>").alias("borders")).first()["borders"] or []
    return list(dict.fromkeys(found))


def _slice(time: Column, borders: Sequence[str], kind: T.DataType) -> Column:
    """How many borders are not after ``time``, by halving."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        border = F.lit(borders[middle]).cast(kind)
        return F.when(time < border, between(low, middle)).otherwise(between(middle + 1, high))

    return between(0, len(borders))
