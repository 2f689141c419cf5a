"""Compare large tables by digests of key ranges, and name the cells that differ.

Keys are dealt by hash to a fixed number of ranges. A range's digest is its number of rows and
four sums of 32-bit parts of its rows' hashes; sums do not depend on order, so they add up in every
task before one small row a range is shuffled. Tables are compared by their digests first. Only rows
of ranges that differ are compared one by one, so what is shuffled shrinks with the differences.

Digests can be kept with a table and added to those of further rows: comparing with a table
whose digests are kept reads it only where ranges differ. Rows are told apart by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespan.operators.compare import frames_diff, shown
from tablespan.operators.schema import quoted
from tablespan.operators.statistics import as_value

RANGE_BITS = 16
MOST_RANGE_BITS = 20  # a million numbers of ranges, the most that are sent to all tasks

_SUMS = ("first_low", "first_high", "second_low", "second_high")


def range_number(frame: DataFrame, key: Sequence[str], bits: int = RANGE_BITS) -> Column:
    """The number of the range that a row's key is dealt to."""
    if not 1 <= bits <= MOST_RANGE_BITS:
        raise ValueError(f"a table has 2^1 to 2^{MOST_RANGE_BITS} ranges, not 2^{bits}")
    unknown = [c for c in key if c not in frame.columns]
    if unknown or not key:
        raise ValueError(f"no such key columns: {unknown}" if unknown else "a comparison needs a key")
    return F.shiftrightunsigned(_hash(frame, key, 0), 64 - bits).cast("int")


def digests(frame: DataFrame, key: Sequence[str], bits: int = RANGE_BITS) -> DataFrame:
    """(range, rows, four sums): a row for each range that has rows."""
    first, second = (_hash(frame, sorted(frame.columns), seed) for seed in (1, 2))
    low = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))
    high = lambda h: F.shiftrightunsigned(h, 32)
    parts = dict(zip(_SUMS, (low(first), high(first), low(second), high(second))))
    rows = frame.select(range_number(frame, key, bits).alias("range"), *[p.alias(n) for n, p in parts.items()])
    return rows.groupBy("range").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(n).alias(n) for n in _SUMS])


def added(one: DataFrame, other: DataFrame) -> DataFrame:
    """The digests of two tables' rows together."""
    return one.unionByName(other).groupBy("range").agg(*[F.sum(n).alias(n) for n in ("rows", *_SUMS)])


def differing_ranges(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(range): the ranges whose digests differ, or that only one of the tables has."""
    numbers = ("rows", *_SUMS)
    signed = [side.select("range", *[(F.col(n) * sign).alias(n) for n in numbers]) for side, sign in ((actual, 1), (expected, -1))]
    sums = signed[0].unionByName(signed[1]).groupBy("range").agg(*[F.sum(n).alias(n) for n in numbers])
    return sums.where(" OR ".join(f"{n} <> 0" for n in numbers)).select("range")


def rows_differ(
    actual: DataFrame,
    expected: DataFrame,
    key: Sequence[str],
    bits: int = RANGE_BITS,
    actual_digests: DataFrame | None = None,
    expected_digests: DataFrame | None = None,
) -> DataFrame:
    """What :func:`frames_diff` reports, found by comparing rows of differing ranges only.

    Both frames need the same columns and types, without maps.  Digests that are at hand must have been
    made with the same key and ``bits``.
    """
    known = (actual_digests or digests(actual, key, bits), expected_digests or digests(expected, key, bits))
    # At most 2^MOST_RANGE_BITS whole numbers.
    ranges = F.broadcast(differing_ranges(*known))
    sides = [side.join(ranges, range_number(side, key, bits) == F.col("range"), "left_semi") for side in (actual, expected)]
    return frames_diff(*sides)


def cells_differ(differences: DataFrame, key: Sequence[str]) -> DataFrame:
    """The report of differing rows by key: key columns, column_name, actual, expected, extra, missing.

    A key with one extra and one missing row gives a row for each cell that differs, with both cells as
    text.  Any other key gives one row without a column, with its numbers of extra and missing rows.
    """
    fields = [f for f in differences.schema.fields if f.name not in ("side", "copies")]
    columns = F.struct(*[F.col(quoted(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    sides = {"extra": "actual", "missing": "expected"}
    measures = []
    for side, name in sides.items():
        own = F.col("side") == side
        measures.append(F.sum(F.when(own, F.col("copies")).otherwise(0)).alias(f"n_{side}"))
        measures.append(F.any_value(F.when(own, columns), True).alias(f"row_{name}"))
    named = differences.select("side", "copies", *[F.col(quoted(f.name)) for f in fields])
    numbers = {f.name: i for i, f in enumerate(fields)}
    by_key = named.groupBy(*[F.col(quoted(k)).alias(f"k{numbers[k]}") for k in key]).agg(*measures)
    cells = []
    for i, field in enumerate(fields):
        if field.name not in key:
            a, e = F.col(f"row_actual.c{i}"), F.col(f"row_expected.c{i}")
            cell = F.struct(
                F.lit(field.name).alias("column_name"),
                shown(a, field.dataType).alias("actual"),
                shown(e, field.dataType).alias("expected"),
            )
            cells.append(F.when(~a.eqNullSafe(e), cell))
    nothing = F.struct(*[F.lit(None).cast("string").alias(n) for n in ("column_name", "actual", "expected")])
    paired = (F.col("n_extra") == 1) & (F.col("n_missing") == 1)
    found = F.when(paired, F.array_compact(F.array(*cells))).otherwise(F.array(nothing)) if cells else F.array(nothing)
    keys = [F.col(f"k{numbers[k]}").alias(k) for k in key]
    listed = by_key.select(*keys, F.col("n_extra").alias("extra"), F.col("n_missing").alias("missing"), F.explode(found).alias("cell"))
    return listed.select(*[F.col(quoted(k)) for k in key], "cell.column_name", "cell.actual", "cell.expected", "extra", "missing")


def _hash(frame: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """64 bits of the named cells. Spark's hash passes over NULLs, so it also gets where they are."""
    types = {f.name: f.dataType for f in frame.schema.fields}
    parts = [F.lit(seed)]
    for name in columns:
        value = as_value(F.col(quoted(name)), types[name])[1]
        parts += [value.isNull(), value]
    return F.xxhash64(*parts)
