"""Joins by time and by overlap, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablespan.operators import asof
from tablespan.operators.asof import join_as_of
from tablespan.operators.intervals import join_overlaps


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def made(seed, n=300):
    draw = random.Random(seed)
    keys = [None, *["hot"] * 4, *"abcdef"]
    left = [(i, draw.choice(keys), draw.choice([None, *range(60)])) for i in range(n)]
    right = [(draw.choice(keys), draw.choice([None, *range(50)]), i, draw.choice([None, "x", "y"])) for i in range(n)]
    return left + left[:20], right + right[:20]


def expected(left, right, before, within, how):
    out = []
    for i, key, at in left:
        fitting = [
            (t, n, v) for k, t, n, v in right
            if None not in (key, at, k, t) and k == key and (t < at if before else t <= at) and (within is None or t >= at - within)
        ]
        if fitting:
            out.append((i, key, at, *max(fitting, key=lambda f: f[:2])[1:]))
        elif how == "left":
            out.append((i, key, at, None, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("before, within, how, slices", [(False, None, "left", 32), (True, None, "inner", 5), (False, 3, "left", 1), (True, 4, "inner", 7)])
def test_as_of_against_brute_force(spark, before, within, how, slices):
    for seed in (1, 2):
        left, right = made(seed)
        a = spark.createDataFrame(left, "i int, k string, t int").repartition(3)
        b = spark.createDataFrame(right, "key string, at int, n int, v string").withColumnRenamed("key", "k").repartition(4)
        found = join_as_of(a, b, ["k"], "t", "at", ["n", "v"], ["n"], before, None if within is None else F.lit(within), how, slices)
        assert found.columns == ["i", "k", "t", "n", "v"]
        assert sorted(map(tuple, found.collect()), key=repr) == expected(left, right, before, within, how)


def test_as_of_over_nothing_and_with_many_kinds_of_time(spark):
    empty = spark.createDataFrame([], "k int, at int, n int")
    some = spark.createDataFrame([(1, 5)], "k int, t int")
    assert [tuple(r) for r in join_as_of(some, empty, ["k"], "t", "at", ["n"]).collect()] == [(1, 5, None)]
    assert join_as_of(some.limit(0), empty, ["k"], "t", "at", ["n"]).collect() == []
    for kind in ("date", "timestamp", "timestamp_ntz", "double", "decimal(20,3)"):
        text = "cast(id + 20000 as {0})" if kind[0] == "d" and kind != "date" else "cast(date_from_unix_date(cast(id + 20000 as int)) as {0})"
        times = spark.range(40).selectExpr("1 AS k", f"{text.format(kind)} AS at", "id AS n")
        asked = times.select("k", F.col("at").alias("t")).where("n % 2 = 0" if "n" in ("k", "t") else F.lit(True))
        found = join_as_of(asked, times, ["k"], "t", "at", ["n"], slices=4, before=True).collect()
        assert sorted((r.n is None, r.n or 0) for r in found) == [*[(False, n) for n in range(39)], (True, 0)]


def test_rows_of_a_hot_key_are_dealt_to_slices(spark):
    events = spark.range(40_000).selectExpr("if(id % 3 > 0, 'hot', string(id)) AS k", "cast(power(id, 3) AS double) AS at", "id AS n")
    borders = asof._borders(events, "at", 16)
    parts = events.withColumn("slice", asof._slice(F.col("at"), borders, events.schema["at"].dataType)).groupBy("k", "slice").count()
    sizes = sorted(r["count"] for r in parts.where("k = 'hot'").collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
    asked = events.select("k", F.col("at").alias("t"))
    assert join_as_of(asked, events, ["k"], "t", "at", ["n"]).where("n IS NULL").count() == 0


def test_as_of_refusals(spark):
    a = spark.createDataFrame([(1, 5)], "k int, t int")
    b = spark.createDataFrame([(1, 5, 2)], "k int, at bigint, n int")
    for wrong in (
        lambda: join_as_of(a, b, [], "t", "at", ["n"]),
        lambda: join_as_of(a, b, ["k"], "t", "at", ["n"]),
        lambda: join_as_of(a, a, ["k"], "t", "t", ["t"]),
        lambda: join_as_of(a, a, ["k"], "t", "t", [], how="full"),
        lambda: join_as_of(a, a, ["k"], "t", "t", [], slices=0),
    ):
        with pytest.raises((ValueError, TypeError)):
            wrong()


def intervals(draw, n, exact=True):
    ends = []
    for i in range(n):
        low = draw.choice([draw.randint(-50, 50), draw.randint(0, 10_000), draw.uniform(0, 100)])
        high = low + draw.choice([0, 0, draw.randint(0, 5), draw.randint(0, 300), 4 ** draw.randint(0, 7), -1])
        ends.append((i, draw.choice("ab"), float(low), float(high)))
    inf = float("inf")
    return ends + [(n, "a", None, 3.0), (n + 1, "a", -inf, inf), (n + 2, "b", 5.0, inf), (n + 3, None, 1.0, 2.0), (n + 4, "a", float("nan"), float("nan"))]


def test_overlaps_against_brute_force(spark):
    for seed in (1, 2):
        draw = random.Random(seed)
        left, right = intervals(draw, 150), intervals(draw, 200)
        left += left[:10]
        a = spark.createDataFrame(left, "i int, k string, low double, high double").repartition(3)
        b = spark.createDataFrame(right, "j int, g string, start double, stop double").repartition(3)
        fits = lambda x, y: None not in (x[2], y[2]) and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]
        found = join_overlaps(a, b, ("low", "high"), ("start", "stop"))
        assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
        want = sorted((x[0], y[0]) for x in left for y in right if fits(x, y))
        assert sorted((r.i, r.j) for r in found.collect()) == want
        found = join_overlaps(a, b, ("low", "high"), ("start", "stop"), [("k", "g")])
        want = sorted((x[0], y[0]) for x in left for y in right if fits(x, y) and x[1] is not None and x[1] == y[1])
        assert sorted((r.i, r.j) for r in found.collect()) == want


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "bigint", "decimal(12,2)"])
def test_ends_of_many_kinds(spark, kind):
    start, stop = ("id * 7", "id * 7 + id % 20") if kind in ("bigint", "decimal(12,2)") else ("date_add(DATE '2020-02-01', cast(id * 7 AS int))", "date_add(DATE '2020-02-01', cast(id * 7 + id % 20 AS int))")
    a = spark.range(60).selectExpr("id AS i", f"cast({start} AS {kind}) AS low", f"cast({stop} AS {kind}) AS high")
    b = a.toDF("j", "start", "stop")
    spans = [(i * 7, i * 7 + i % 20) for i in range(60)]
    want = sorted((i, j) for i, x in enumerate(spans) for j, y in enumerate(spans) if x[0] <= y[1] and y[0] <= x[1])
    assert sorted((r.i, r.j) for r in join_overlaps(a, b, ("low", "high"), ("start", "stop")).collect()) == want


def test_long_intervals_are_not_entered_more_often(spark):
    short = spark.range(20_000).selectExpr("id AS i", "id AS low", "id + 1 AS high")
    long = spark.createDataFrame([(0, 0, 20_000), (1, 10_000, 10_500)], "j int, start bigint, stop bigint")
    pairs = join_overlaps(short, long, ("low", "high"), ("start", "stop"))
    assert pairs.groupBy("j").count().orderBy("j").collect() == [(0, 20_000), (1, 502)]
    generated = join_overlaps(short.limit(1), long, ("low", "high"), ("start", "stop"))
    assert generated.count() == 1


def test_overlaps_of_nothing_and_refusals(spark):
    a = spark.createDataFrame([], "i int, low int, high int")
    b = spark.createDataFrame([(1, 2, 3)], "j int, start int, stop int")
    found = join_overlaps(a, b, ("low", "high"), ("start", "stop"))
    assert found.collect() == [] and found.columns == ["i", "low", "high", "j", "start", "stop"]
    with pytest.raises(ValueError):
        join_overlaps(b, b, ("start", "stop"), ("start", "stop"))
    texts = spark.createDataFrame([("x", "y")], "low string, high string")
    with pytest.raises(TypeError):
        join_overlaps(texts, texts.toDF("c", "d"), ("low", "high"), ("c", "d"))
    with pytest.raises(TypeError):
        join_overlaps(texts, b, ("low", "high"), ("start", "stop"))
    moments = [dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 2)]
    c = spark.createDataFrame([(1, moments[0], moments[0]), (2, moments[1], moments[1])], "i int, low timestamp_ntz, high timestamp_ntz")
    assert join_overlaps(c, c.toDF("j", "start", "stop"), ("low", "high"), ("start", "stop")).count() == 2
