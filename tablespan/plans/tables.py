"""Table definitions: small frozen values held on the driver, never data."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import types as T

from tablespan.operators.arrow_types import spark_schema
from tablespan.plans.predicates import ColumnPath
from tablespan.sources.branches import Branch


@dataclass(frozen=True)
class Table:
    """One logical table.

    ``schema`` may be left out only for a table with a single branch, which then
    brings its own.  ``planning="filtered"`` allows a table without branches: it
    is empty.  Each group in ``required_filters`` needs a filter on one of its
    paths before the table may be scanned.  ``row_estimate`` is what the owner
    declares; unknown stays ``None``.  ``exclusive`` declares that no row passes
    the filters of two branches over one source, which makes their scan cheaper.
    A schema may also be given as an Arrow schema.
    """

    name: str
    branches: tuple[Branch, ...]
    schema: T.StructType | pa.Schema | None = None
    planning: str = "bind"
    required_filters: tuple[tuple[ColumnPath, ...], ...] = ()
    row_estimate: int | None = None
    exclusive: bool = False

    def __post_init__(self) -> None:
        if isinstance(self.schema, pa.Schema):
            object.__setattr__(self, "schema", spark_schema(self.schema))
        if self.planning not in ("bind", "filtered"):
            raise ValueError(f"table '{self.name}': unknown planning '{self.planning}'")
        if not self.branches and self.planning != "filtered":
            raise ValueError(
                f"table '{self.name}': no branches; only a filtered table may be empty"
            )
        if self.schema is None and len(self.branches) != 1:
            raise ValueError(f"table '{self.name}': a declared schema is needed")


class UnknownVersionError(LookupError):
    """No version of the table satisfies the request."""


@dataclass(frozen=True)
class Version:
    label: str
    table: Table
    committed_at: dt.datetime | None = None


@dataclass(frozen=True)
class VersionedTable:
    """A table with a history; each version keeps its own schema and branches.

    ``versions`` are oldest first.  ``default`` names the version read when none
    is asked for; left out, it is the last.
    """

    name: str
    versions: tuple[Version, ...]
    default: str | None = None

    def pick(self, version: str | None = None, as_of: dt.datetime | None = None) -> Table:
        """The definition valid for a version label or at a moment (to the second)."""
        if version is not None and as_of is not None:
            raise ValueError(f"table '{self.name}': give a version or a moment, not both")
        if as_of is not None:
            return self._at(as_of.replace(microsecond=0))
        wanted = version if version is not None else self.default
        if wanted is None:
            return self.versions[-1].table
        for candidate in self.versions:
            if candidate.label == str(wanted):
                return candidate.table
        raise UnknownVersionError(f"table '{self.name}' has no version '{wanted}'")

    def _at(self, moment: dt.datetime) -> Table:
        dated = sorted(
            (v for v in self.versions if v.committed_at is not None), key=lambda v: v.committed_at
        )
        place = bisect_right([v.committed_at for v in dated], moment)
        if place == 0:
            raise UnknownVersionError(f"table '{self.name}' has no version as of {moment}")
        return dated[place - 1].table
