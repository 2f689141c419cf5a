"""Joins of intervals that overlap, with or without other equalities."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.schema import quoted

#: How much wider the buckets of a level are than those of the one below.
WIDENING = 4


def join_overlaps(
    left: DataFrame,
    right: DataFrame,
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    keys: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Pairs of rows whose closed intervals share a point: all columns of both sides.

    There is a level of buckets for each order of length.  An interval's own level
    has buckets at least as wide as it is long, so it lies in two of them at most; it is
    entered there and at each wider level that the other side has as its own.  Two
    intervals meet at the wider one of their own levels, in the first bucket that holds
    both, and nowhere else.  So long intervals are not entered more often than short
    ones, all joins are on equal buckets, and no pair comes twice.

    Both ends have one type for all: numbers, dates or timestamps; they may be infinite.  Intervals
    with a NULL or NaN end, or that end before they begin, overlap nothing.  ``keys`` are pairs of
    columns that must be equal as well.  Column names of both sides must differ.
    """
    clash = [c for c in left.columns if c in right.columns]
    if clash:
        raise ValueError(f"both sides have columns {clash}")
    ends = [(left, c) for c in left_interval] + [(right, c) for c in right_interval]
    kinds = {frame.schema[c].dataType.simpleString() for frame, c in ends}
    if len(kinds) > 1 and not all(isinstance(f.schema[c].dataType, T.NumericType) for f, c in ends):
        raise TypeError(f"ends of intervals differ in type: {sorted(kinds)}")
    sides = [_placed(left, left_interval, [k for k, _ in keys]), _placed(right, right_interval, [k for _, k in keys])]
    width, levels = _levels(*sides)
    if not levels[0] or not levels[1]:
        return left.limit(0).join(right.limit(0), F.lit(True))
    a, b = (s.withColumn("level", _level(F.col("high") - F.col("low"), width)) for s in sides)
    # The wider side is entered at its own level only; equal levels belong to the first join.
    own = lambda level: F.array(level)
    wide_left = _met(_entered(a, width, own), _entered(b, width, lambda x: _among(levels[0], lambda n: n >= x)), len(keys))
    wide_right = _met(_entered(a, width, lambda x: _among(levels[1], lambda n: n > x)), _entered(b, width, own), len(keys))
    pairs = wide_left.unionByName(wide_right)
    return pairs.select("left_row.*", "right_row.*")


def _position(column: Column, kind: T.DataType) -> Column:
    """An end as a number in the same order; the distance of two is a length."""
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.unix_date(column.cast("date")) * F.lit(86400.0) + F.hour(column) * 3600 + F.minute(column) * 60
        return seconds + F.extract(F.lit("SECOND"), column).cast("double")
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    raise TypeError(f"a {kind.simpleString()} cannot be the end of an interval")


def _placed(frame: DataFrame, interval: tuple[str, str], keys: Sequence[str]) -> DataFrame:
    """(keys, low, high, begin, end, row): ends as they are, and as finite numbers that choose the buckets."""
    begin, end = (F.col(quoted(c)) for c in interval)
    kind = frame.schema[interval[0]].dataType
    low, high = _position(begin, kind), _position(end, frame.schema[interval[1]].dataType)
    good = reduce(Column.__and__, [F.col(quoted(k)).isNotNull() for k in keys], (begin <= end) & ~F.isnan(low) & ~F.isnan(high))
    low, high = (F.greatest(F.least(x, F.lit(1e300)), F.lit(-1e300)) for x in (low, high))
    return frame.where(good).select(
        *[F.col(quoted(k)).alias(f"key_{i}") for i, k in enumerate(keys)],
        low.alias("low"), high.alias("high"), begin.alias("begin"), end.alias("end"),
        F.struct(*[F.col(quoted(c)) for c in frame.columns]).alias("row"),
    )


def _levels(left: DataFrame, right: DataFrame) -> tuple[float, list[list[int]]]:
    """The width of the narrowest buckets, and the levels that are own ones of some interval of each side.

    The width is the median length of intervals that are longer than a point; one row comes to the driver
    from each of two reads of the ends.
    """
    length = F.col("high") - F.col("low")
    both = left.select(length.alias("l"), "high").unionAll(right.select(length.alias("l"), "high"))
    median = F.percentile_approx(F.when(F.col("l") > 0, F.col("l")), 0.5, 1000)
    found = both.agg(median.alias("width"), (F.max("high") - F.min("high")).alias("reach")).first()
    width = found["width"] or (found["reach"] or 1.0) / 1e6 or 1.0
    own = [s.agg(F.collect_set(_level(length, width)).alias("l")) for s in (left, right)]
    levels = own[0].withColumn("side", F.lit(0)).unionAll(own[1].withColumn("side", F.lit(1))).collect()
    return width, [sorted(next(r["l"] for r in levels if r["side"] == k)) for k in (0, 1)]


def _level(length: Column, width: float) -> Column:
    """The lowest level whose buckets are as wide as the interval is long; of such there are less than 1,100."""
    exact = F.ceil(F.log(F.greatest(length / width, F.lit(1.0))) / F.log(F.lit(float(WIDENING)))).cast("int")
    # Logarithms are rounded; one level more is always wide enough.
    return F.when(F.pow(F.lit(float(WIDENING)), exact) * width >= length, exact).otherwise(exact + 1)


def _bucket(position: Column, level: Column, width: float) -> Column:
    return F.floor(position / (F.pow(F.lit(float(WIDENING)), level) * width)).cast("double")


def _among(levels: Sequence[int], condition: Callable[[Column], Column]) -> Column:
    return F.filter(F.array(*map(F.lit, levels)), condition)


def _entered(side: DataFrame, width: float, levels: Callable[[Column], Column]) -> DataFrame:
    """An entry (at, bucket) for each bucket that the interval touches at the levels for its own one."""
    rows = side.withColumn("at", F.explode(levels(F.col("level"))))
    first, last = _bucket(F.col("low"), F.col("at"), width), _bucket(F.col("high"), F.col("at"), width)
    # Two buckets but for rounding: then the one between is a third.
    touched = F.array_distinct(F.array(first, F.least(first + 1, last), last))
    return rows.withColumn("first", first).withColumn("bucket", F.explode(touched))


def _met(left: DataFrame, right: DataFrame, keys: int) -> DataFrame:
    names = [f"key_{i}" for i in range(keys)]
    a, b = (
        side.select(*names, "at", "bucket", *[F.col(c).alias(f"{p}_{c}") for c in ("first", "begin", "end", "row")])
        for side, p in ((left, "left"), (right, "right"))
    )
    shared = F.col("bucket") == F.greatest("left_first", "right_first")
    overlap = (F.col("left_begin") <= F.col("right_end")) & (F.col("right_begin") <= F.col("left_end"))
    return a.join(b, [*names, "at", "bucket"]).where(shared & overlap).select("left_row", "right_row")
