"""Table functions called from SQL."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.functions.sql_tables import Parameter, RowFunction, StreamFunction
from tablespan.queries.sql_tables import CALENDAR, JSON_FIELDS, SESSIONS


def test_columns_follow_the_arguments(spark):
    CALENDAR.register(spark)
    call = "SELECT * FROM tablespan_calendar({})"
    year = spark.sql(call.format("DATE '2024-02-28', DATE '2024-03-01'"))
    assert year.columns == ["day", "year"]
    assert [tuple(r) for r in year.collect()] == [(dt.date(2024, 2, 28 + n) if n < 2 else dt.date(2024, 3, 1), 2024) for n in range(3)]
    other = spark.sql(call.format("last => DATE '2024-01-01', parts => 'weekday,month', first => DATE '2024-01-01'"))
    assert other.columns == ["day", "weekday", "month"] and tuple(other.first())[1:] == (1, 1)
    assert spark.sql(call.format("DATE '2024-01-02', DATE '2024-01-01', 'month'")).collect() == []


@pytest.mark.parametrize(
    "arguments",
    [
        "DATE '2024-01-01'",
        "DATE '2024-01-01', DATE '2024-01-02', 'hour'",
        "DATE '2024-01-01', DATE '2024-01-02', 'year', 1",
        "first => DATE '2024-01-01', nothing => 1, last => DATE '2024-01-02'",
        "'2024-01-01', DATE '2024-01-02'",
        "DATE '2024-01-01', DATE '2024-01-02', 7",
    ],
)
def test_calls_that_do_not_fit(spark, arguments):
    CALENDAR.register(spark)
    with pytest.raises((AnalysisException, PySparkException)):
        spark.sql(f"SELECT * FROM tablespan_calendar({arguments})").collect()


def test_a_call_for_each_row(spark):
    JSON_FIELDS.register(spark)
    texts = [(1, '{"a": 1, "b": "x"}'), (2, '{"a": 1.5, "b": [1]}'), (3, None), (4, "no json"), (5, "[1]"), (6, "{}"), (6, "{}")]
    spark.createDataFrame(texts, "i int, t string").createOrReplaceTempView("tablespan_texts")
    rows = spark.sql("SELECT i, f.* FROM tablespan_texts, LATERAL tablespan_json_fields(t, fields => 'a bigint, b string') AS f")
    assert rows.columns == ["i", "a", "b"]
    assert sorted(map(tuple, rows.collect()), key=repr) == [(1, 1, "x"), (2, None, "[1]"), (6, None, None), (6, None, None)]
    with pytest.raises((AnalysisException, PySparkException), match="constant"):
        spark.sql("SELECT f.* FROM tablespan_texts, LATERAL tablespan_json_fields(t, fields => t) AS f")


def test_whole_numbers_fit_fractions_and_long_ones(spark):
    shown = T.StructType().add("x", T.DoubleType()).add("n", T.LongType())
    pair = RowFunction("tablespan_pair", [Parameter("x", T.DoubleType()), Parameter("n", T.LongType(), default=7)], lambda: shown, lambda x, n: [(x, n)])
    pair.register(spark)
    assert tuple(spark.sql("SELECT * FROM tablespan_pair(1)").first()) == (1.0, 7)
    assert tuple(spark.sql("SELECT * FROM tablespan_pair(2.5BD, n => 3)").first()) == (2.5, 3)
    assert tuple(spark.sql("SELECT * FROM tablespan_pair(NULL, NULL)").first()) == (None, None)


def expected_sessions(rows, gap):
    out, by_user = [], {}
    for user, ts, value in rows:
        by_user.setdefault(user, []).append((ts, value))
    for user, events in by_user.items():
        events.sort(key=lambda e: e[0])
        start = 0
        for i in range(1, len(events) + 1):
            if i == len(events) or events[i][0] - events[i - 1][0] > gap:
                part = events[start:i]
                out.append((user, part[0][0], part[-1][0], len(part), sum(v or 0.0 for _, v in part)))
                start = i
    return sorted(out, key=repr)


def test_a_table_streams_through(spark):
    draw = random.Random(3)
    begin = dt.datetime(2024, 1, 1)
    rows = [(draw.choice([None, 1, 1, 1, 2, 3]), begin + dt.timedelta(minutes=draw.randint(0, 3000)), draw.choice([None, 1.0, 2.5])) for _ in range(400)]
    events = spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz, value double").repartition(5)
    for gap in (5, 30):
        found = SESSIONS.over(events, ["user_id"], ["ts"], gap_minutes=gap)
        assert sorted(map(tuple, found.collect()), key=repr) == expected_sessions(rows, dt.timedelta(minutes=gap))
    assert SESSIONS.over(events.limit(0), ["user_id"], ["ts"]).collect() == []
    events.createOrReplaceTempView("tablespan_stream")
    found = spark.sql("SELECT * FROM tablespan_sessions(TABLE(tablespan_stream) PARTITION BY user_id ORDER BY ts)")
    assert sorted(map(tuple, found.collect()), key=repr) == expected_sessions(rows, dt.timedelta(minutes=30))


def test_uneven_tables_are_refused(spark):
    events = spark.range(100).select((F.col("id") % 4).alias("user_id"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"))
    assert SESSIONS.over(events, ["user_id"], ["ts"], most_share=0.3).count() == 4
    with pytest.raises(ValueError, match="25.0%"):
        SESSIONS.over(events, ["user_id"], ["ts"], most_share=0.2)
    with pytest.raises(ValueError, match="key"):
        SESSIONS.over(events, [], ["ts"])
    with pytest.raises((AnalysisException, PySparkException)):
        SESSIONS.over(events, ["user_id"], ["ts"], gap_minutes="x").collect()


def test_a_stream_holds_no_rows(spark):
    state = SESSIONS.begin(gap_minutes=1)
    rows = [T.Row(user_id=1, ts=dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), value=1.0) for i in range(1000)]
    assert [x for r in rows for x in SESSIONS.step(state, r)] == []
    assert SESSIONS.end(state) == [(1, rows[0].ts, rows[-1].ts, 1000, 1000.0)]


def test_streams_travel_in_whole_batches(spark):
    """Spark calls a function whose columns follow from the call once a row, with an Arrow batch for each."""
    events = spark.range(9).select((F.col("id") % 2).alias("user_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"))
    events.createOrReplaceTempView("tablespan_batches")
    SESSIONS.register(spark, events.schema)
    called = spark.sql("SELECT * FROM tablespan_sessions(TABLE(tablespan_batches) PARTITION BY user_id ORDER BY ts)")
    whole_batches = 302  # the kind of a function that takes Arrow batches, as plans show it
    for frame in (SESSIONS.over(events, ["user_id"], ["ts"]), called):
        assert f", {whole_batches}" in frame._jdf.queryExecution().executedPlan().toString()


def test_a_stream_for_one_table(spark):
    draw = random.Random(5)
    begin = dt.datetime(2024, 1, 1)
    rows = [(draw.choice([None, 1, 1, 2]), begin + dt.timedelta(minutes=draw.randint(0, 3000)), draw.choice([None, 1.0])) for _ in range(300)]
    events = spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz, value double").repartition(3)
    events.createOrReplaceTempView("tablespan_fixed")
    SESSIONS.register(spark, events.schema, gap_minutes=5)
    call = "SELECT * FROM tablespan_sessions(TABLE({}) PARTITION BY user_id ORDER BY ts{})"
    found = spark.sql(call.format("tablespan_fixed", ", gap_minutes => 5"))
    assert sorted(map(tuple, found.collect()), key=repr) == expected_sessions(rows, dt.timedelta(minutes=5))
    refused = [("tablespan_fixed", ", gap_minutes => 6"), ("tablespan_fixed", ""), ("tablespan_fixed", ", 5, 5"), ("SELECT user_id, value, ts FROM tablespan_fixed", ", 5")]
    refused += [("SELECT user_id, ts::timestamp AS ts, value FROM tablespan_fixed", ", 5")]
    for table, arguments in refused:
        with pytest.raises((AnalysisException, PySparkException)):
            spark.sql(call.format(table, arguments)).collect()
    with pytest.raises(TypeError, match="no argument"):
        SESSIONS.register(spark, events.schema, gap=5)


def test_streams_keep_their_values(spark):
    """Times with a zone, structs, maps and keys of several batches arrive as a row has them."""
    shown = T.StructType().add("at", T.TimestampType()).add("s", T.StringType()).add("n", T.LongType())

    def step(state, row):
        state.append(1)
        if len(state) % 5000 == 0:
            yield row.at, f"{row.s.a}-{row.m['k']}", len(state)

    echo = StreamFunction("tablespan_echo", [], lambda table: shown, lambda: [], step, lambda state: [(None, None, len(state))])
    rows = spark.range(25000).select(
        F.lit("x").alias("key"), F.timestamp_seconds("id").alias("at"), F.struct((F.col("id") + 1).alias("a")).alias("s"), F.create_map(F.lit("k"), F.lit(7)).alias("m")
    )
    found = [tuple(r) for r in echo.over(rows, ["key"], ["at"]).collect()]
    zero = spark.range(1).select(F.timestamp_seconds(F.lit(0))).first()[0]
    assert found == [(zero + dt.timedelta(seconds=n - 1), f"{n}-7", n) for n in range(5000, 25001, 5000)] + [(None, None, 25000)]
