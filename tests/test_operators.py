import datetime as dt
import math
import sys
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators import aggregates
from tablespan.operators.aggregates import user_aggregate
from tablespan.operators.asof import latest_as_of
from tablespan.operators.compare import as_text, frames_diff
from tablespan.operators.layout import key_grouped, largest_share, store_key_grouped
from tablespan.operators.statistics import column_statistics, estimated_rows, profile_branches
from tablespan.plans.catalog import Catalog, UnknownTableError
from tablespan.functions.vectors import group_centroids
from tablespan.plans.predicates import Bounds, at
from tablespan.plans.scan import kept_branches, scan
from tablespan.plans.tables import Table
from tablespan.queries.aggregates import CommonDivisor
from tablespan.sources.branches import (
    frame_branch,
    function_branch,
    partitioned_files,
    scan_function,
)
from tablespan.sources.sequences import sequence
from tablespan.sources.shared import kept_and_measured

# Workers cannot import this file, so what they need of it travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def exchanges(frame):
    """How many shuffles the initial physical plan holds."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line and "Broadcast" not in line for line in plan.splitlines())


def third(spark, rows=30_000):
    """Rows of which a third share the key 0."""
    return spark.range(rows).selectExpr("if(id % 3 = 0, 0L, id) AS k", "id AS v")


# Statistics


def test_statistics_of_every_kind_of_column(spark):
    frame = spark.createDataFrame(
        [(1, 1.5, "a", None, dt.date(2020, 1, 1), [1], {"k": 1}),
         (3, None, "", None, dt.date(2020, 1, 2), [1], {"k": 1}),
         (3, -2.0, "long", None, None, [2], {"k": 2})],
        "i int, d double, s string, n int, t date, a array<int>, m map<string,int>",
    )
    found = {r.column_name: r for r in column_statistics(frame).collect()}
    assert len(found) == 7 and all(r.row_count == 3 for r in found.values())
    assert tuple(found["i"])[3:] == (0, 2, "1", "3", None)
    assert tuple(found["d"])[3:] == (1, 2, "-2.0", "1.5", None)
    assert tuple(found["s"])[3:] == (0, 3, "", "long", 4)
    assert tuple(found["n"])[3:] == (3, 0, None, None, None)
    assert tuple(found["t"])[3:] == (1, 2, None, None, None)
    assert tuple(found["a"])[3:] == (0, 2, None, None, None)
    assert tuple(found["m"])[3:] == (0, None, None, None, None)


def test_statistics_of_nothing_and_of_chosen_columns(spark):
    empty = spark.createDataFrame([], "a int, b string")
    rows = column_statistics(empty, ["a"]).collect()
    assert [tuple(r)[2:6] for r in rows] == [(0, 0, 0, None)]
    assert column_statistics(empty, ["a"], distinct=None).first().distinct_count is None
    with pytest.raises(ValueError):
        column_statistics(empty, ["zzz"])
    with pytest.raises(ValueError):
        column_statistics(empty, distinct="some")


def test_exact_and_sketched_distinct_counts(spark):
    frame = spark.range(20_000).selectExpr("id % 5000 AS v")
    assert column_statistics(frame).first().distinct_count == 5000
    assert abs(column_statistics(frame, distinct="approx").first().distinct_count - 5000) < 500


def test_measured_bounds_skip_branches_and_never_rows(spark):
    schema = T.StructType.fromDDL("n bigint, s struct<x: string>")
    make = lambda low, high: frame_branch(spark.range(low, high).selectExpr("id", "named_struct('x', concat('p', id))"))
    nothing = frame_branch(spark.createDataFrame([], schema))
    nulls = frame_branch(spark.createDataFrame([(None, None)], schema))
    table = Table("t", (make(0, 10), make(10, 20), nothing, nulls), schema)
    known = profile_branches(spark, table, [("n",), ("s", "x")])
    assert len(kept_branches(table, [at("n") > 12])) == 4
    assert len(kept_branches(known, [at("n") > 12])) == 1
    assert len(kept_branches(known, [at("n").is_null()])) == 1
    assert len(kept_branches(known, [at("s", "x") == "p3"])) == 1
    assert len(kept_branches(known, [])) == 4
    for where in ([at("n") > 12], [at("n").is_null()], [at("n") == 99], [~(at("n") > 3)]):
        assert scan(spark, known, where=where).count() == scan(spark, table, where=where).count()
    assert scan(spark, known, where=at("n") == 99).columns == ["n", "s"]


def test_zoned_timestamps_have_no_measured_range(spark):
    moments = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00Z' AS t UNION ALL SELECT null")
    known = profile_branches(spark, Table("t", (frame_branch(moments),), moments.schema), [("t",)])
    bounds = known.branches[0].bounds[("t",)]
    assert (bounds.low, bounds.high, bounds.nulls, bounds.rows) == (None, None, 1, 2)
    assert kept_branches(known, [at("t") > dt.datetime(2030, 1, 1)])


def test_branches_over_one_source_share_a_read_and_keep_their_copies(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/p")
    source = scan_function("read_parquet", f"{tmp_path}/p")
    table = Table(
        "t",
        (source.filtered("id < 6"), source.filtered("id % 2 = 0"), source.filtered("id > null"), source),
        T.StructType().add("id", T.LongType()),
    )
    rows = scan(spark, table)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    expected = sorted(
        [i for i in range(6)] + [i for i in range(10) if i % 2 == 0] + list(range(10))
    )
    assert sorted(r.id for r in rows.collect()) == expected
    assert sorted(r.id for r in scan(spark, table, where=at("id") > 5).collect()) == [6, 6, 7, 8, 8, 9]
    known = profile_branches(spark, table, [("id",)])
    measured = [known.branches[i].bounds[("id",)] for i in range(4)]
    assert [(b.low, b.high, b.rows) for b in measured] == [(0, 5, 6), (0, 8, 5), (None, None, 0), (0, 9, 10)]
    few = replace(table, branches=known.branches[:3])
    assert [n for n, _ in kept_branches(few, [at("id") > 8])] == []
    assert scan(spark, few, where=at("id") > 8).count() == 0


def test_row_estimates_are_declared_or_unknown():
    branch = function_branch(sequence, 5)
    assert Table("t", (branch,)).row_estimate is None
    assert Table("t", (branch,), row_estimate=10_000).row_estimate == 10_000


# Layout


def test_key_grouping_costs_one_exchange(spark):
    frame = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
    laid = key_grouped(frame, ["k"], 8)
    assert exchanges(laid) == 1
    assert exchanges(laid.groupBy("k").agg(F.sum("v"))) == 1
    assert exchanges(laid.groupBy("k", (F.col("v") % 2).alias("p")).count()) == 1


def test_keys_inside_structs(spark):
    frame = spark.range(0, 400, 1, 20).selectExpr("named_struct('a', id % 4) AS s", "id")
    laid = key_grouped(frame, [("s", "a")], 4)
    assert exchanges(laid.groupBy("s.a").count()) == 1


def test_uneven_keys_can_be_refused(spark, tmp_path):
    frame = third(spark)
    assert largest_share(frame, ["k"]) == pytest.approx(1 / 3, abs=1e-3)
    with pytest.raises(ValueError, match="33.3%"):
        key_grouped(frame, ["k"], most_share=0.25)
    with pytest.raises(ValueError, match="33.3%"):
        store_key_grouped(frame, "laid_uneven", ["k"], 8, f"{tmp_path}/u", most_share=0.25)
    laid = key_grouped(frame, ["k"], most_share=0.5)
    assert exchanges(laid) == 1 and laid.groupBy("k").count().where("k = 0").first()["count"] == 10_000
    assert largest_share(frame.where("v < 0"), ["k"]) == 0.0


def test_stored_grouping_needs_no_exchange(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = store_key_grouped(
            spark.range(100).selectExpr("id % 9 AS k", "id AS v"), "laid_left", ["k"], 4, f"{tmp_path}/l"
        )
        right = store_key_grouped(
            spark.range(9).selectExpr("id AS k", "id * 2 AS w"), "laid_right", ["k"], 4, f"{tmp_path}/r"
        )
        joined = left.join(right, "k").groupBy("k").agg(F.sum("w").alias("w"))
        assert exchanges(joined) == 0
        assert joined.count() == 9
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS laid_left")
        spark.sql("DROP TABLE IF EXISTS laid_right")


# As-of


def test_latest_row_per_key(spark):
    moments = [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, 9, "d"), (3, 1, None)]
    frame = spark.createDataFrame(moments, "k int, t int, v string")
    rows = latest_as_of(frame, ["k"], "t", 8, ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 7, "c"), (3, 1, None)]
    assert rows[0].asDict().keys() == {"k", "t", "v"}


def test_latest_row_of_a_heavy_key_is_combined_before_the_shuffle(spark):
    frame = third(spark).withColumn("id", F.col("v"))
    newest = latest_as_of(frame, ["k"], "v", 10**9, ["id"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    assert newest.where("k = 0").first().v == 29_997


# Comparison


def test_differences_are_counted(spark):
    ddl = "a int, b string"
    actual = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "")], ddl)
    expected = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, "z"), (4, "z")], ddl)
    found = sorted(tuple(r) for r in frames_diff(actual, expected).collect())
    assert found == sorted(
        [("extra", 1, "x", 1), ("extra", 3, "", 1), ("missing", 3, None, 1), ("missing", 4, "z", 2)],
    )
    assert frames_diff(actual, actual).count() == 0
    assert exchanges(frames_diff(actual, expected)) == 1


def test_many_copies_stay_one_row(spark):
    many = spark.range(100_000).selectExpr("1 AS a")
    assert [tuple(r) for r in frames_diff(many, many.limit(1)).collect()] == [("extra", 1, 99_999)]


def test_frames_of_other_shapes_are_refused(spark):
    one = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="columns differ"):
        frames_diff(one, one.toDF("b"))
    with pytest.raises(ValueError, match="'a' is int"):
        frames_diff(one, one.select(F.col("a").cast("bigint")))
    with pytest.raises(ValueError, match="clash"):
        frames_diff(one.toDF("side"), one.toDF("side"))


def test_cells_as_text(spark):
    frame = spark.createDataFrame([(None, "", 1.5, bytearray(b"\x01"))], "a int, b string, c double, d binary")
    assert tuple(as_text(frame).first()) == ("NULL", "(empty)", "1.5", "01")


# User-defined aggregates


class Count:
    state = "n bigint"
    result = "bigint"

    def start(self, rows):
        return pd.DataFrame({"n": np.ones(len(rows), dtype="int64")}, index=rows.index)

    def combine(self, groups):
        return groups.sum()

    def finish(self, states):
        return states["n"].astype("int64[pyarrow]")

    def empty(self):
        return (0,)


def test_aggregate_of_pinned_groups(spark):
    frame = spark.createDataFrame([(1, 12), (1, 18), (2, 100), (2, 75), (2, None)], "k int, i int")
    rows = user_aggregate(frame, ["k"], CommonDivisor(), ["i"], "g").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 6), (2, 25)]


class Spread:
    """Largest minus smallest value, times the share of rows that have one."""

    state = "low double, high double, present bigint, total bigint"
    result = "double"

    def start(self, rows):
        value = rows.iloc[:, 0]
        present = value.notna().astype("int64[pyarrow]")
        one = pd.Series(1, index=rows.index, dtype="int64[pyarrow]")
        return pd.DataFrame({"low": value, "high": value, "present": present, "total": one})

    def combine(self, groups):
        return groups.agg({"low": "min", "high": "max", "present": "sum", "total": "sum"})

    def finish(self, states):
        return (states.high - states.low) * states.present / states.total

    def empty(self):
        return (None, None, 0, 0)


def test_aggregates_see_nulls_and_null_keys(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", None), (None, 5.0), (None, 9.0)], "k string, v double")
    rows = {r.k: r.s for r in user_aggregate(frame, ["k"], Spread(), ["v"], "s").collect()}
    assert rows == {"a": 0.0, None: 4.0}


def test_aggregate_over_nothing(spark):
    nothing = spark.range(0).selectExpr("id AS k", "id AS v")
    assert [tuple(r) for r in user_aggregate(nothing, [], Count()).collect()] == [(0,)]
    assert user_aggregate(nothing, ["k"], Count()).count() == 0
    assert user_aggregate(nothing.selectExpr("cast(v AS double) AS v"), [], Spread(), ["v"]).first().result is None


def test_nullary_aggregate(spark):
    frame = spark.range(0, 100_000, 1, 7)
    assert user_aggregate(frame, [], Count()).first().result == 100_000


@pytest.mark.parametrize("held", [100_000, 500])
def test_heavy_and_many_groups_with_states_passed_on(spark, monkeypatch, held):
    monkeypatch.setattr(aggregates, "STATES_PER_TASK", held)
    frame = third(spark)
    counted = user_aggregate(frame, ["k"], Count(), result="n")
    assert frames_diff(counted, frame.groupBy("k").agg(F.count(F.lit(1)).alias("n"))).count() == 0


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(9,2)", "boolean", "double"])
def test_keys_of_many_types(spark, kind):
    source = {"date": "date_add(DATE '2020-01-01', cast(id % 5 AS int))",
              "timestamp": "timestamp_seconds(id % 5)",
              "timestamp_ntz": "cast(timestamp_seconds(id % 5) AS timestamp_ntz)",
              "decimal(9,2)": "cast(id % 5 / 4 AS decimal(9,2))", "boolean": "id % 2 = 0",
              "double": "cast(id % 5 AS double) / 3"}[kind]
    frame = spark.range(1000).selectExpr(f"if(id % 7 = 0, null, {source}) AS k", "id")
    counted = user_aggregate(frame, ["k"], Count(), result="n")
    assert frames_diff(counted, frame.groupBy("k").agg(F.count(F.lit(1)).alias("n"))).count() == 0


def test_nested_keys_are_refused(spark):
    frame = spark.sql("SELECT array(1) AS k, 1 AS v")
    with pytest.raises(TypeError, match="'k'"):
        user_aggregate(frame, ["k"], Count())


def test_common_divisor_against_brute_force(spark):
    frame = spark.range(2000).selectExpr("id % 13 AS k", "(id * 7919) % 360 AS v")
    expected = {}
    for row in frame.collect():
        expected[row.k] = math.gcd(expected.get(row.k, 0), row.v)
    found = user_aggregate(frame, ["k"], CommonDivisor(), ["v"], "g").collect()
    assert {r.k: r.g for r in found} == expected


@pytest.mark.parametrize("shares", [1, 4])
def test_float_keys_group_as_in_spark(spark, shares):
    values = [0.0, -0.0, math.nan, None, 1.5, 0.0, -0.0]
    frame = spark.createDataFrame([(v,) for v in values] * 40, "k double").repartition(4)
    counted = user_aggregate(frame, ["k"], Count(), result="n", shares=shares)
    assert frames_diff(counted, frame.groupBy("k").agg(F.count(F.lit(1)).alias("n"))).count() == 0
    assert exchanges(user_aggregate(spark.range(9), ["id"], Count())) == 1


def test_wide_rows_are_folded_in_bounded_pieces(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "BYTES_AT_ONCE", 1)
    frame = spark.range(1000).selectExpr("id % 3 AS k", "repeat('x', 1000) AS v")
    assert {r.result for r in user_aggregate(frame, ["k"], Count(), ["v"]).collect()} == {333, 334}


def test_statistics_name_every_unknown_column(spark):
    with pytest.raises(ValueError, match="zzz.*yyy"):
        column_statistics(spark.range(3), ["id", "zzz", "yyy"])


def test_row_estimates_come_from_the_owner_or_from_measured_branches(spark):
    branches = tuple(frame_branch(spark.range(n).toDF("n")) for n in (3, 4))
    table = Table("t", branches, T.StructType().add("n", T.LongType()))
    assert estimated_rows(table) is None
    assert estimated_rows(profile_branches(spark, table, [("n",)])) == 7
    assert estimated_rows(replace(table, row_estimate=10_000)) == 10_000


def test_as_of_needs_keys(spark):
    with pytest.raises(ValueError, match="key"):
        latest_as_of(spark.range(3), [], "id", dt.datetime(2024, 1, 1))


def test_hundreds_of_filtered_branches_share_a_read(spark, tmp_path):
    spark.range(1000).toDF("n").write.parquet(f"{tmp_path}/n")
    source = scan_function("read_parquet", f"{tmp_path}/n")
    parts = tuple(source.filtered(f"n % 1000 = {i}") for i in range(1000))
    schema = T.StructType().add("n", T.LongType())
    for exclusive in (True, False):
        assert scan(spark, Table("t", parts, schema, exclusive=exclusive)).count() == 1000
    twice = Table("t", (source.filtered("n < 10"), source.filtered("n < 20")), schema)
    assert scan(spark, twice).count() == 30


def test_zoned_and_local_moments_do_not_skip_branches(spark):
    known = Bounds(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    later = at("t") > dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)
    assert later.may_hold({("t",): known})
    assert not (at("t") > dt.datetime(2030, 1, 1)).may_hold({("t",): known})


def test_planned_files_follow_the_data(spark, tmp_path):
    days = spark.sql(
        """SELECT if(id % 11 = 0, NULL, timestampadd(DAY, cast(id * 40 AS int), TIMESTAMP_NTZ '1990-01-01')) AS day, id
        FROM range(200) WHERE id NOT BETWEEN 20 AND 60"""
    )
    days.withColumn("year", F.year("day")).write.partitionBy("year").parquet(f"{tmp_path}/d")

    def dates(values):
        if values["year"] is None:
            return {}
        year = int(values["year"])
        return {("day",): Bounds(dt.datetime(year, 1, 1), dt.datetime(year, 12, 31, 23, 59, 59, 999999))}

    branches = partitioned_files(spark, f"{tmp_path}/d", dates)
    table = Table("d", branches, days.schema, planning="filtered")
    early = at("day") < dt.datetime(1992, 1, 1)
    assert {b.label[-5:-1] for _, b in kept_branches(table, [early])} == {"1990", "1991", "ON__"}
    assert scan(spark, table, where=early).count() == days.where("day < '1992-01-01'").count() > 0
    assert scan(spark, table).count() == days.count()
    assert scan(spark, table, where=at("day") > dt.datetime(2050, 1, 1)).count() == 0


def test_centroids_keep_groups_without_cells(spark):
    frame = spark.createDataFrame([(1, [1.0, 3.0]), (1, [3.0]), (2, []), (3, None)], "k int, v array<double>")
    found = {r.k: r.centroid for r in group_centroids(frame, ["k"], "v").collect()}
    assert found == {1: [2.0, 3.0], 2: None, 3: None}


# Catalog


def test_catalog(spark):
    numbers = Table("numbers", (function_branch(sequence, 100),))
    catalog = Catalog("example", default_namespace=("data",))
    catalog.add(numbers)
    catalog.add(numbers, ("data", "deep.er"))
    catalog.add(numbers, ("main",))
    assert catalog.namespaces() == [("data",), ("main",)]
    assert catalog.namespaces(("data",)) == [("data", "deep.er")]
    assert catalog.tables() == ["numbers"] and catalog.tables(("none",)) == []
    assert catalog.has("numbers") and not catalog.has("letters")
    rows = catalog.scan(spark, "numbers", where=[at("n") > 90, at("n") <= 95])
    assert [r.n for r in rows.orderBy("n").collect()] == [91, 92, 93, 94, 95]
    assert tuple(catalog.scan(spark, "numbers").agg(F.count("n"), F.sum("n")).first()) == (100, 4950)
    view = catalog.publish(spark, "numbers", view="published_numbers")
    assert spark.sql(f"SELECT sum(n) FROM {view} WHERE n < 10").first()[0] == 45
    with pytest.raises(UnknownTableError, match="data.letters"):
        catalog.table("letters")
    with pytest.raises(ValueError, match="already"):
        catalog.add(numbers)


def test_many_branches_make_a_shallow_plan(spark):
    table = Table(
        "t", tuple(function_branch(sequence, 3) for _ in range(200)), T.StructType().add("n", T.LongType())
    )
    assert scan(spark, table, where=at("n") > 0).count() == 400


def test_a_kept_table_is_measured_while_it_is_written(spark):
    rows = spark.createDataFrame([(1, 2.5), (2, None), (2, 1.0), (None, 4.0)], "a long, b double").repartition(3)
    measures = F.count("*"), F.sum("a"), F.max("b")
    frame, values = kept_and_measured(spark, rows, *measures)
    assert values == (4, 5, 4.0) and sorted(map(tuple, frame.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    for nothing in (rows.limit(0), rows.filter("a > 9"), rows.join(rows.filter("a > 9").select("a"), "a").distinct()):
        frame, values = kept_and_measured(spark, nothing, *measures)
        assert values == (0, None, None) and frame.count() == 0
