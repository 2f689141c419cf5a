"""Statistics merged from kept parts, against one pass over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tablespan.operators.sketches import measured_parts
from tablespan.operators.statistics import column_statistics

SCHEMA = "part string, n int, x double, s string, many array<string>, m map<string, int>, at timestamp"


def made(spark, seed, n=500):
    draw = random.Random(seed)
    rows = [
        (
            draw.choice([None, "a", "b", "hot", "hot"]), draw.choice([None, *range(60)]), draw.choice([None, 0.0, -0.0, float("nan"), i / 7 - 9]),
            draw.choice([None, "", "é" * draw.randint(0, 5)]), draw.choice([None, [], [None, "x"], ["x", None]]), {"k": i}, None,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def without_counts(report):
    return sorted(map(repr, report.drop("distinct_count").collect()))


def counts(report):
    return {r.column_name: r.distinct_count for r in report.collect()}


def test_parts_add_up_to_the_whole(spark):
    rows = made(spark, 1)
    known = measured_parts(spark, rows, F.col("part"))
    assert known.parts.count() == 4
    merged, whole = known.table(), column_statistics(rows)
    assert without_counts(merged) == without_counts(whole)
    exact = counts(whole)
    for name, estimate in counts(merged).items():
        assert estimate == exact[name] if exact[name] is None else abs(estimate - exact[name]) <= 0.06 * exact[name]


def test_some_parts(spark):
    rows = made(spark, 2)
    known = measured_parts(spark, rows, F.col("part"), ["n", "s"])
    some = known.table(F.col("part").isin("a", "b"))
    assert without_counts(some) == without_counts(column_statistics(rows.where("part IN ('a', 'b')"), ["n", "s"]))


def test_parts_are_added_and_replaced(spark):
    first, later = made(spark, 3), made(spark, 4).where("part = 'hot' OR part IS NULL")
    known = measured_parts(spark, first, F.col("part"), ["n", "x"]).with_rows(spark, later, F.col("part"))
    now = first.where("part IN ('a', 'b')").unionByName(later)
    assert without_counts(known.table()) == without_counts(column_statistics(now, ["n", "x"]))


def test_only_kept_parts_are_read(spark, tmp_path):
    made(spark, 5).write.parquet(str(tmp_path / "source"))
    rows = spark.read.parquet(str(tmp_path / "source"))
    report = measured_parts(spark, rows, F.col("_metadata.file_name"), ["n"]).table()
    assert report.first().row_count == 500
    assert not any("source" in f for f in report.inputFiles())


def test_a_large_count_is_close(spark):
    rows = spark.range(200_000).selectExpr("id AS n", "id % 40 AS part")
    estimate = measured_parts(spark, rows, F.col("part"), ["n"]).table().first().distinct_count
    assert abs(estimate - 200_000) < 0.06 * 200_000


def test_empty_and_refused(spark):
    none = made(spark, 1).limit(0)
    report = measured_parts(spark, none, F.col("part"), ["n", "s"]).table().collect()
    assert [(r.row_count, r.null_count, r.distinct_count, r.min_value) for r in report] == [(0, 0, 0, None)] * 2
    with pytest.raises(ValueError, match="nothing"):
        measured_parts(spark, none, F.col("part"), ["nothing"])
    with pytest.raises(ValueError, match="n"):
        measured_parts(spark, none, F.col("part"), ["n"]).with_rows(spark, none.select("part"), F.col("part"))
