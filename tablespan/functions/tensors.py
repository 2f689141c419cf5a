"""Tensors with named axes, turned into long tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest_tensor(tensor: Column, axes: Mapping[str, Column]) -> Column:
    """An array of ``{value, axes: {…}}``, one per cell.

    ``tensor`` is an array nested once per axis, outermost axis first; each axis
    is the array of its labels.  Cells come in storage order.
    """
    if not axes:
        raise ValueError("a tensor needs at least one axis")
    return _cells(tensor, list(axes.items()), [])


def _cells(part: Column, axes: list[tuple[str, Column]], labels: list[Column]) -> Column:
    (name, values), rest = axes[0], axes[1:]

    def here(item: Column, place: Column) -> Column:
        so_far = [*labels, F.get(values, place).alias(name)]
        if rest:
            return _cells(item, rest, so_far)
        return F.struct(item.alias("value"), F.struct(*so_far).alias("axes"))

    found = F.transform(part, here)
    return F.flatten(found) if rest else found


def tensor_rows(
    frame: DataFrame, tensor: Column, axes: Mapping[str, Column], keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per cell: the kept columns, a column per axis, and ``value``."""
    cells = frame.select(*keep, F.explode(unnest_tensor(tensor, axes)).alias("cell"))
    return cells.select(
        *keep,
        *[F.col("cell.axes").getField(name).alias(name) for name in axes],
        F.col("cell.value").alias("value"),
    )
