"""Row counts and per-column statistics, and value ranges that let a scan skip branches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.schema import quoted, union_all
from tablespan.plans.predicates import Bounds, ColumnPath
from tablespan.plans.scan import BRANCH, branch_rows
from tablespan.plans.tables import Table

# The types whose smallest and largest value are reported.
BOUNDED_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.StringType,
)


def column_statistics(
    frame: DataFrame, columns: Sequence[str] = (), distinct: str | None = "exact"
) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, smallest and largest, longest text.

    Everything but exact distinct counts comes from one read and one row per task.
    ``distinct="exact"`` reads each column once more: narrow rows of its number and one
    value are combined inside each task, and what is left is shuffled.
    ``"approx"`` keeps a small sketch per column instead (about 2 % standard
    error) and is the choice for wide or very large tables.  ``None`` leaves the
    count unknown, and so are those of columns that hold maps.
    """
    if distinct not in ("exact", "approx", None):
        raise ValueError(f"distinct must be 'exact', 'approx' or None, not {distinct!r}")
    unknown = [c for c in columns if c not in frame.columns]
    if unknown:
        raise ValueError(f"column_statistics: no such columns: {unknown}")
    fields = [f for f in frame.schema.fields if not columns or f.name in columns]
    measures: list[Column] = [F.count(F.lit(1)).alias("rows")]
    rows: list[Column] = []
    unknown_text, unknown_count = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for i, field in enumerate(fields):
        column = F.col(quoted(field.name))
        bounded = isinstance(field.dataType, BOUNDED_TYPES)
        text = isinstance(field.dataType, T.StringType)
        sketched = distinct == "approx" and not holds_map(field.dataType)
        measures.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        if bounded:
            measures += [F.min(column).alias(f"low_{i}"), F.max(column).alias(f"high_{i}")]
        if text:
            measures.append(F.max(F.length(column)).alias(f"length_{i}"))
        if sketched:
            measures.append(F.approx_count_distinct(column, 0.02).alias(f"distinct_{i}"))
        rows.append(
            F.struct(
                F.lit(i).alias("number"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("rows").alias("row_count"),
                F.col(f"nulls_{i}").alias("null_count"),
                (F.col(f"distinct_{i}") if sketched else unknown_count).alias("distinct_count"),
                (F.col(f"low_{i}").cast("string") if bounded else unknown_text).alias("min_value"),
                (F.col(f"high_{i}").cast("string") if bounded else unknown_text).alias("max_value"),
                (F.col(f"length_{i}").cast("bigint") if text else unknown_count).alias(
                    "max_length"
                ),
            )
        )
    measured = frame.agg(*measures).select(F.inline(F.array(*rows)))
    if distinct == "exact":
        counted = [f for f in enumerate(fields) if not holds_map(f[1].dataType)]
        counts = distinct_counts(frame, counted).withColumnRenamed("number", "of")
        # One row per column.
        joined = measured.join(F.broadcast(counts), F.col("number") == F.col("of"), "left")
        known = F.col("number").isin([i for i, _ in counted])
        several = F.when(known, F.coalesce("several", F.lit(0).cast("bigint")))
        measured = joined.withColumn("distinct_count", several).drop("of", "several")
    return measured.drop("number")


def distinct_counts(frame: DataFrame, fields: Sequence[tuple[int, T.StructField]]) -> DataFrame:
    """(number, several): how many different values, not counting NULL, each numbered column has.

    Columns of one kind (whole numbers, fractions, texts) are read together as narrow rows of
    (number, value), so equal ones meet in the hash table of the task that reads them and no
    column is read twice.  Fractions compare as Spark groups them: 0.0 with -0.0 and NaN with NaN.
    """
    kinds: dict[str, list[Column]] = {}
    for number, field in fields:
        kind, value = as_value(F.col(quoted(field.name)), field.dataType)
        kinds.setdefault(kind, []).append(F.struct(F.lit(number).alias("number"), value.alias("value")))
    counts = []
    for cells in kinds.values():
        rows = frame.select(F.explode(F.array(*cells)).alias("cell")).where("cell.value IS NOT NULL")
        counts.append(rows.select("cell.*").distinct().groupBy("number").agg(F.count(F.lit(1)).alias("several")))
    none = frame.sparkSession.createDataFrame([], "number int, several bigint")
    return union_all(counts) if counts else none


def as_value(column: Column, kind: T.DataType) -> tuple[str, Column]:
    """A value in a form that keeps it apart from all others of its column, and the form's kind."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "fraction", column.cast("double")
    if isinstance(kind, T.BooleanType):
        return "whole", column.cast("int").cast("bigint")
    if isinstance(kind, T.IntegralType):
        return "whole", column.cast("bigint")
    if isinstance(kind, T.TimestampType):
        return "whole", F.unix_micros(column)
    if isinstance(kind, T.BinaryType):
        return "text", F.hex(column)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        text = F.to_json(F.struct(_alike(column, kind).alias("v")), {"ignoreNullFields": "false"})
        return "text", F.when(column.isNotNull(), text)
    return "text", column.cast("string")


def _alike(column: Column, kind: T.DataType) -> Column:
    """A nested value with -0.0 as 0.0, and binary parts and moments as text that tells them apart."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(column == 0, F.lit(0.0).cast(kind)).otherwise(column)
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda v: _alike(v, kind.elementType))
    if isinstance(kind, T.StructType):
        # Fields by number: two of one name would become one in the text.
        fields = [_alike(column.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else column
    return column


def holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    return isinstance(kind, T.MapType)


def estimated_rows(table: Table) -> int | None:
    """How many rows a table has as far as is known without reading it.

    The owner's declaration comes first, then the measured counts of its branches;
    if one of them is not known, neither is the sum.
    """
    if table.row_estimate is not None:
        return table.row_estimate
    counts = [max((b.rows for b in branch.bounds.values() if b.rows is not None), default=None) for branch in table.branches]
    return None if any(c is None for c in counts) else sum(counts)


def profile_branches(spark: SparkSession, table: Table, paths: Sequence[ColumnPath]) -> Table:
    """The same table with measured value ranges on every branch.

    One job reads only the named columns of all branches and returns one row per
    branch.  Zoned timestamps get counts but no range: on the driver they are local
    times, whose order breaks when clocks are set back.  Keep the result (it is
    plain data) and scan it as often as the sources stay unchanged.
    """
    if not table.branches:
        return table
    values = [
        F.col(".".join(quoted(p) for p in path)).alias(f"v{i}") for i, path in enumerate(paths)
    ]
    rows = union_all(branch_rows(spark, table, list(enumerate(table.branches))))
    tagged = rows.select(F.col(BRANCH).alias("branch"), *values)
    measures = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(paths)):
        value = F.col(f"v{i}")
        zoned = isinstance(tagged.schema[f"v{i}"].dataType, T.TimestampType)
        measures += [
            (F.lit(None) if zoned else F.min(value)).alias(f"low{i}"),
            (F.lit(None) if zoned else F.max(value)).alias(f"high{i}"),
            F.count_if(value.isNull()).alias(f"nulls{i}"),
        ]
    measured = tagged.groupBy("branch").agg(*measures).collect()
    by_number = {row["branch"]: row for row in measured}
    branches = []
    for number, branch in enumerate(table.branches):
        row = by_number.get(number)
        known = {
            path: Bounds(row[f"low{i}"], row[f"high{i}"], row[f"nulls{i}"], row["rows"])
            if row
            else Bounds(nulls=0, rows=0)
            for i, path in enumerate(paths)
        }
        branches.append(branch.bounded({**branch.bounds, **known}))
    return replace(table, branches=tuple(branches))
