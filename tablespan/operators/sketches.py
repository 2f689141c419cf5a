"""Column statistics that add up: measured a part at a time, kept, and merged without reading the rows again.

A part is whatever comes and goes together, such as a file, a day or a branch. Its row holds counts, bounds
and a sketch of different values for each column, a few kilobytes in all; a table's statistics are
an aggregate over those rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.schema import quoted
from tablespan.operators.statistics import BOUNDED_TYPES, as_value, holds_map
from tablespan.sources.shared import kept

SKETCH_BITS = 12  # of a register's number: 4,096 registers, about 2 % standard error


@dataclass(frozen=True)
class PartStatistics:
    """``parts`` has part, rows, and nulls_i, low_i, high_i, length_i and sketch_i for field i where it has one.

    Columns with maps have no sketch; bounds are kept for numbers and texts, lengths for texts.
    """

    fields: tuple[T.StructField, ...]
    parts: DataFrame

    def table(self, wanted: Column | None = None) -> DataFrame:
        """The report of ``column_statistics`` over all parts, or those for which ``wanted`` (over ``part``) is true.

        Distinct counts are estimates; of equal bounds (0.0 and -0.0) either is shown. No part gives counts of zero
        and no bounds.
        """
        parts = self.parts if wanted is None else self.parts.where(wanted)
        measures = [F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("rows")]
        report = []
        none = {kind: F.lit(None).cast(kind) for kind in ("string", "bigint")}
        for i, field in enumerate(self.fields):
            measures.append(F.coalesce(F.sum(f"nulls_{i}"), F.lit(0).cast("bigint")).alias(f"nulls_{i}"))
            bounded, text, sketched = _measured(field)
            if bounded:
                measures += [F.min(f"low_{i}").alias(f"low_{i}"), F.max(f"high_{i}").alias(f"high_{i}")]
            if text:
                measures.append(F.max(f"length_{i}").alias(f"length_{i}"))
            if sketched:
                several = F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{i}"))
                measures.append(F.coalesce(several, F.lit(0).cast("bigint")).alias(f"distinct_{i}"))
            report.append(
                F.struct(
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("data_type"),
                    F.col("rows").alias("row_count"),
                    F.col(f"nulls_{i}").alias("null_count"),
                    (F.col(f"distinct_{i}") if sketched else none["bigint"]).alias("distinct_count"),
                    (F.col(f"low_{i}").cast("string") if bounded else none["string"]).alias("min_value"),
                    (F.col(f"high_{i}").cast("string") if bounded else none["string"]).alias("max_value"),
                    (F.col(f"length_{i}").cast("bigint") if text else none["bigint"]).alias("max_length"),
                )
            )
        return parts.agg(*measures).select(F.inline(F.array(*report)))

    def with_rows(self, spark: SparkSession, rows: DataFrame, part: Column) -> PartStatistics:
        """The statistics with the parts that ``rows`` are all of; parts known by the same name are replaced."""
        missing = [f.name for f in self.fields if f not in rows.schema.fields]
        if missing:
            raise ValueError(f"the rows lack columns, or have other types: {missing}")
        more = kept(spark, _by_part(rows, self.fields, part))
        names = more.select(F.col("part").alias("again"))
        rest = self.parts.join(names, F.col("part").eqNullSafe(F.col("again")), "left_anti")
        return replace(self, parts=kept(spark, rest.unionByName(more)))


def measured_parts(spark: SparkSession, rows: DataFrame, part: Column, columns: Sequence[str] = ()) -> PartStatistics:
    """The statistics of each part of the rows, in one read of the named columns (all where none is)."""
    unknown = [c for c in columns if c not in rows.columns]
    if unknown:
        raise ValueError(f"measured_parts: no such columns: {unknown}")
    fields = tuple(f for f in rows.schema.fields if not columns or f.name in columns)
    return PartStatistics(fields, kept(spark, _by_part(rows, fields, part)))


def _measured(field: T.StructField) -> tuple[bool, bool, bool]:
    kind = field.dataType
    return isinstance(kind, BOUNDED_TYPES), isinstance(kind, T.StringType), not holds_map(kind)


def _by_part(rows: DataFrame, fields: Sequence[T.StructField], part: Column) -> DataFrame:
    measures = [F.count(F.lit(1)).alias("rows")]
    cells = []
    for i, field in enumerate(fields):
        cells.append(F.col(quoted(field.name)).alias(f"v{i}"))
        value = F.col(f"v{i}")
        bounded, text, sketched = _measured(field)
        measures.append(F.count_if(value.isNull()).alias(f"nulls_{i}"))
        if bounded:
            measures += [F.min(value).alias(f"low_{i}"), F.max(value).alias(f"high_{i}")]
        if text:
            measures.append(F.max(F.length(value)).alias(f"length_{i}"))
        if sketched:
            # By hash, so that fractions count as Spark groups them and all types have one kind of sketch.
            hashed = F.when(value.isNotNull(), F.xxhash64(as_value(value, field.dataType)[1]))
            measures.append(F.hll_sketch_agg(hashed, F.lit(SKETCH_BITS)).alias(f"sketch_{i}"))
    return rows.select(part.cast("string").alias("part"), *cells).groupBy("part").agg(*measures)
