"""Distances and centroids of points given as arrays or structs of numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespan.operators.schema import quoted


def _squared(a: Column, b: Column) -> Column:
    return (a - b) * (a - b)


def distance_arrays(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays; arrays of unequal length give NULL."""
    parts = F.zip_with(a, b, lambda x, y: _squared(x.cast("double"), y.cast("double")))
    return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda total, part: total + part))


def distance_structs(a: Column, b: Column, coordinates: Sequence[str]) -> Column:
    """Euclidean distance of two structs over the named fields."""
    parts = [
        _squared(a.getField(c).cast("double"), b.getField(c).cast("double")) for c in coordinates
    ]
    return F.sqrt(reduce(Column.__add__, parts))


def centroid_of_structs(points: Sequence[Column], coordinates: Sequence[str]) -> Column:
    """The mean point of several struct columns of one row."""
    if not points:
        raise ValueError("a centroid needs at least one point")

    def mean(coordinate: str) -> Column:
        values = [p.getField(coordinate).cast("double") for p in points]
        return (reduce(Column.__add__, values) / F.lit(float(len(values)))).alias(coordinate)

    return F.struct(*[mean(c) for c in coordinates])


def group_centroids(
    frame: DataFrame, keys: Sequence[str], vector: str, centroid: str = "centroid"
) -> DataFrame:
    """The mean array of each group.

    Positions are averaged one by one, with sums combined inside each task
    first; what is gathered per group is one number per position.  A group whose
    vectors are all empty or NULL keeps its row, with a NULL centroid.
    """
    groups = [F.col(quoted(k)) for k in keys]
    cells = frame.select(*groups, F.posexplode_outer(F.col(quoted(vector))).alias("position", "value"))
    mean = F.avg(F.col("value").cast("double"))
    means = cells.groupBy(*groups, "position").agg(mean.alias("mean"))
    gathered = means.groupBy(*groups).agg(
        F.array_sort(
            F.collect_list(F.when(F.col("position").isNotNull(), F.struct("position", "mean")))
        ).alias("means")
    )
    mean_point = F.transform("means", lambda m: m.getField("mean"))
    return gathered.select(*groups, F.when(F.size("means") > 0, mean_point).alias(centroid))

