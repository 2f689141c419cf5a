"""Table functions called from SQL: columns by argument, LATERAL calls, and streams over a table."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.functions.sql_tables import Parameter, RowFunction, StreamFunction
from tablespan.queries.registry import query, read

_PARTS = {"year": lambda d: d.year, "quarter": lambda d: (d.month + 2) // 3, "month": lambda d: d.month, "weekday": lambda d: d.isoweekday()}


def _calendar_columns(parts: str) -> T.StructType:
    schema = T.StructType().add("day", T.DateType())
    for part in parts.split(","):
        if part not in _PARTS:
            raise ValueError(f"calendar: unknown part '{part}'; known: {sorted(_PARTS)}")
        schema = schema.add(part, T.IntegerType())
    return schema


def _calendar_rows(first: dt.date, last: dt.date, parts: str) -> Iterator[tuple]:
    for n in range((last - first).days + 1):
        day = first + dt.timedelta(days=n)
        yield (day, *(_PARTS[p](day) for p in parts.split(",")))


CALENDAR = RowFunction(
    "tablespan_calendar",
    [Parameter("first", T.DateType()), Parameter("last", T.DateType()), Parameter("parts", T.StringType(), constant=True, default="year")],
    _calendar_columns,
    _calendar_rows,
)


@query(
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, count(*) AS n
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY ALL
    """
)
def table_function_analyzed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by a calendar's columns, which its third argument names; arguments in any order."""
    CALENDAR.register(spark)
    return spark.sql(
        """SELECT year, quarter, count(*) AS n
        FROM tablespan_calendar(parts => 'year,quarter', last => DATE '1999-12-31', first => DATE '1995-01-01')
        JOIN {orders} ON CAST(o_orderdate AS DATE) = day GROUP BY year, quarter""",
        orders=read(spark, folder, "orders"),
    )


@query(
    """
    SELECT CAST(isodow(o_orderdate) AS INTEGER) AS weekday, count(*) AS n, count(DISTINCT o_custkey) AS n_customers
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY ALL
    """
)
def table_function_analyzed_narrow(spark: SparkSession, folder: str) -> DataFrame:
    """The same function with one other column."""
    CALENDAR.register(spark)
    return spark.sql(
        """SELECT weekday, count(*) AS n, count(DISTINCT o_custkey) AS n_customers
        FROM tablespan_calendar(DATE '1996-01-01', DATE '1997-12-31', 'weekday')
        JOIN {orders} ON CAST(o_orderdate AS DATE) = day GROUP BY weekday""",
        orders=read(spark, folder, "orders"),
    )


# What the kind of a JSON field is called in an argument.
_JSON_KINDS = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def _json_columns(fields: str) -> T.StructType:
    schema = T.StructType()
    for field in fields.split(","):
        name, _, kind = field.strip().partition(" ")
        if kind.strip() not in _JSON_KINDS:
            raise ValueError(f"json fields: '{name}' needs a kind of {sorted(_JSON_KINDS)}, got '{kind}'")
        schema = schema.add(name, _JSON_KINDS[kind.strip()])
    return schema


@cache  # once a worker, not once a row
def _columns_of(fields: str) -> T.StructType:
    return _json_columns(fields)


def _json_rows(text: str | None, fields: str) -> Iterator[tuple]:
    """One row a text that holds an object; a value of another kind than its field is NULL."""
    try:
        held = json.loads(text or "null")
    except ValueError:
        return
    if isinstance(held, dict):
        yield tuple(_json_value(held.get(f.name), f.dataType) for f in _columns_of(fields))


def _json_value(value: object, kind: T.DataType) -> object:
    if isinstance(kind, T.LongType):
        return value if type(value) is int else None
    if isinstance(kind, T.DoubleType):
        return float(value) if type(value) in (int, float) else None
    return None if value is None else value if isinstance(value, str) else json.dumps(value)


JSON_FIELDS = RowFunction(
    "tablespan_json_fields",
    [Parameter("text", T.StringType()), Parameter("fields", T.StringType(), constant=True)],
    _json_columns,
    _json_rows,
)


@query(
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing
    FROM events WHERE event_type = 'signup'
    """
)
def table_function_lateral(spark: SparkSession, folder: str) -> DataFrame:
    """A call for each event, with columns that an argument declares."""
    JSON_FIELDS.register(spark)
    return spark.sql(
        """SELECT event_id, f.k, f.missing
        FROM {events} e, LATERAL tablespan_json_fields(e.props, fields => 'k bigint, missing string') AS f
        WHERE event_type = 'signup'""",
        events=read(spark, folder, "events"),
    )


@query(
    """
    SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS DOUBLE)) AS total
    FROM events GROUP BY event_type
    """
)
def table_function_lateral_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The same function with other columns."""
    JSON_FIELDS.register(spark)
    return spark.sql(
        """SELECT event_type, count(*) AS n, sum(f.k) AS total
        FROM {events} e, LATERAL tablespan_json_fields(fields => 'k double', text => e.props) AS f
        GROUP BY event_type""",
        events=read(spark, folder, "events"),
    )


@dataclass
class _Session:
    gap: dt.timedelta
    key: object = None
    first: dt.datetime | None = None
    last: dt.datetime | None = None
    events: int = 0
    total: float = 0.0

    def row(self) -> tuple:
        return self.key, self.first, self.last, self.events, self.total


def _session_step(session: _Session, row: Row) -> Iterator[tuple]:
    if session.events and row["ts"] - session.last > session.gap:
        yield session.row()
        session.events, session.total = 0, 0.0
    if not session.events:
        session.key, session.first = row["user_id"], row["ts"]
    session.last = row["ts"]
    session.events += 1
    session.total += row["value"] or 0.0


def _session_columns(table: T.StructType, gap_minutes: int) -> T.StructType:
    schema = T.StructType().add("user_id", table["user_id"].dataType)
    schema = schema.add("first_ts", table["ts"].dataType).add("last_ts", table["ts"].dataType)
    return schema.add("n_events", T.LongType()).add("total", T.DoubleType())


SESSIONS = StreamFunction(
    "tablespan_sessions",
    [Parameter("gap_minutes", T.LongType(), constant=True, default=30)],
    _session_columns,
    lambda gap_minutes: _Session(dt.timedelta(minutes=gap_minutes)),
    _session_step,
    lambda session: [session.row()] if session.events else [],
)

_SESSIONS_SQL = """
    WITH marked AS (SELECT user_id, ts, value, event_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL {0} MINUTE THEN 0 ELSE 1 END AS new
                    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM marked)
    SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_events, round(sum(value), 4) AS total
    FROM numbered GROUP BY user_id, session
"""


@query(_SESSIONS_SQL.format(1440))
def table_function_over_table(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of each user, made while the user's events stream by in their order."""
    events = read(spark, folder, "events")
    SESSIONS.register(spark, events.schema, gap_minutes=1440)
    return spark.sql(
        """SELECT user_id, first_ts, last_ts, n_events, round(total, 4) AS total
        FROM tablespan_sessions(TABLE({events}) PARTITION BY user_id ORDER BY (ts, event_id), gap_minutes => 1440)""",
        events=events,
    )


@query(_SESSIONS_SQL.format(30))
def table_function_over_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The same over a DataFrame; a user with more than a tenth of all events would be refused."""
    events = read(spark, folder, "events")
    sessions = SESSIONS.over(events, ["user_id"], ["ts", "event_id"], most_share=0.1)
    return sessions.withColumn("total", F.round("total", 4))
