"""Delimited text read against a declared schema, without quoting or escaping.

Lines come from Spark's text reader, so large files are split over tasks and
blank lines stay rows.  Splitting, NULL rules and typing are column expressions.
Only a header needs help: the text reader does not say which line came first in
its file.  One small vectorised function marks it from two hashes of the file's
path and the offset of the split; the text itself never leaves the JVM.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.schema import row_id_schema, union_all


@dataclass(frozen=True)
class TextOptions:
    delimiter: str = ","
    header: bool = False
    null_text: str | None = None

    @staticmethod
    def parse(options: Mapping[str, Any]) -> TextOptions:
        """Read ``delim``, ``header`` and ``nullstr``; other keys are ignored."""
        delimiter = str(options["delim"]) if options.get("delim") is not None else ","
        if len(delimiter) != 1:
            raise ValueError(f"the delimiter has to be a single character; got {delimiter!r}")
        header = options.get("header")
        if header is not None and not isinstance(header, bool):
            raise ValueError(f"header must be True or False, not {header!r}")
        null_text = options.get("nullstr")
        return TextOptions(
            delimiter,
            bool(header),
            None if null_text is None else str(null_text),
        )


# The types a text cell can become, and how an integer is written.
_INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL_TYPES = (T.FloatType, T.DoubleType)
_INTEGER_PATTERN = "^[+-]?[0-9]+$"


def _pattern(delimiter: str) -> str:
    """The delimiter as a regular expression Java can split by without a regex engine."""
    return delimiter if delimiter.isalnum() else "\\" + delimiter


def _parsed(cell: Column, field: T.StructField) -> Column:
    """The text of one cell as the declared type, NULL where it cannot be read."""
    kind = field.dataType
    if isinstance(kind, T.StringType):
        return cell
    if isinstance(kind, T.BooleanType):
        return F.lower(cell) == F.lit("true")
    if isinstance(kind, _INTEGER_TYPES):
        # Spark would also read an integer with blanks around it.
        return F.when(cell.rlike(_INTEGER_PATTERN), cell.try_cast(kind))
    if isinstance(kind, _REAL_TYPES):
        return cell.try_cast(kind)
    raise TypeError(f"column '{field.name}': text cannot be read as {kind.simpleString()}")


def _checked(cell: Column, value: Column, field: T.StructField) -> Column:
    """The value; raises where a number was given that could not be read."""
    kind = field.dataType
    if not isinstance(kind, _INTEGER_TYPES + _REAL_TYPES):
        return value
    message = F.concat(F.lit(f"column '{field.name}': not a {kind.simpleString()}: "), cell)
    unreadable = value.isNull() & cell.isNotNull()
    return F.when(unreadable, F.raise_error(message).cast(kind)).otherwise(value)


def _cells(
    lines: DataFrame, schema: T.StructType, places: list[int | None], options: TextOptions
) -> DataFrame:
    """Split each line once, take the cells, parse them, check them.

    Each step is a projection of its own: Spark merges projections only where
    that repeats no work, while one big expression would split the line anew
    for every use of a cell.
    """
    cells = lines.select(F.split("value", _pattern(options.delimiter), -1).alias("cells"))
    blank = "" if options.null_text is None else options.null_text
    taken, parsed, checked = [], ["*"], []
    for i, (field, place) in enumerate(zip(schema.fields, places)):
        text = F.lit(None).cast("string") if place is None else F.get("cells", F.lit(place))
        taken.append(F.nullif(text, F.lit(blank)).alias(f"cell_{i}"))
        parsed.append(_parsed(F.col(f"cell_{i}"), field).alias(f"value_{i}"))
        value = _checked(F.col(f"cell_{i}"), F.col(f"value_{i}"), field)
        checked.append(value.alias(field.name, metadata=field.metadata))
    return cells.select(*taken).select(*parsed).select(*checked)


def _begins_file(
    batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]],
) -> Iterator[pa.Array]:
    """True on the first row a task sees of each file part that starts at offset 0.

    A task reads its file parts one after another, so a row is such a first row
    exactly when it differs from the row before it in file or offset.
    """
    before = None
    for hash_a, hash_b, offset in batches:
        if len(offset) == 0:
            yield pa.array([], pa.bool_())
            continue
        changed = None
        for values, last in zip((hash_a, hash_b, offset), before or (None, None, None)):
            head = pa.array([last], values.type)
            previous = pa.concat_arrays([head, values.slice(0, len(values) - 1)])
            differs = pc.fill_null(pc.not_equal(values, previous), True)
            changed = differs if changed is None else pc.or_(changed, differs)
        before = (hash_a[-1].as_py(), hash_b[-1].as_py(), offset[-1].as_py())
        yield pc.and_(changed, pc.equal(offset, 0))


def _marked(lines: DataFrame, *metadata: str) -> DataFrame:
    # Not deterministic in Spark's sense: it must see every line of the file, so
    # no later filter may be moved below it.
    begins_file = F.arrow_udf(_begins_file, T.BooleanType()).asNondeterministic()
    hashed = lines.select(
        "value",
        *metadata,
        F.xxhash64("_metadata.file_path").alias("hash_a"),
        F.crc32(F.col("_metadata.file_path").cast("binary")).alias("hash_b"),
        F.col("_metadata.file_block_start").alias("offset"),
    )
    return hashed.withColumn("begins_file", begins_file("hash_a", "hash_b", "offset"))


def _files_of(spark: SparkSession, locations: Sequence[str]) -> list[str]:
    """Every file a location names: itself, a folder's files, or a glob's matches."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        found = pool.map(lambda place: sorted(spark.read.text(place).inputFiles()), locations)
        return [unquote(file) for files in found for file in files]


def _plain(path: str) -> str:
    """One spelling for a path that Spark writes with one slash or three after the scheme."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", unquote(path))


def _headers(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The first line of every file that has one.

    One job whatever the number of files.  The driver, which holds the files' names
    already, gets one number per file and the text of each different header once.
    """
    distinct = sorted(set(files))
    marked = _marked(spark.read.text([_literal(f) for f in distinct]), "_metadata.file_path")
    first = marked.where(F.col("begins_file")).groupBy("value").agg(F.collect_list("file_path").alias("paths"))
    lines: dict[str, str] = {}
    for row in first.toLocalIterator():
        lines.update((_plain(path), row.value) for path in row.paths)
    return {file: lines[_plain(file)] for file in distinct if _plain(file) in lines}


def _literal(path: str) -> str:
    """A file's name with the signs escaped that a glob would read as its own."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_delimited(
    spark: SparkSession, locations: Sequence[str], declared: T.StructType, options: TextOptions
) -> DataFrame:
    """Read the files, each row typed to ``declared``.

    Without a header cells are taken in order.  With one they are taken by name,
    per file; files that share a header are read together, so the plan grows
    with the number of different headers and not with the number of files.
    """
    schema = row_id_schema(declared)
    if not locations:
        return spark.createDataFrame([], schema)
    if not options.header:
        places: list[int | None] = list(range(len(schema)))
        return _cells(spark.read.text(list(locations)), schema, places, options)
    files = _files_of(spark, locations)
    headers = _headers(spark, files)
    layouts: dict[tuple[str, int], list[str]] = {}
    seen: Counter[str] = Counter()
    for file in files:
        if file in headers:
            # A file listed twice is read twice, in separate reads.
            layouts.setdefault((headers[file], seen[file]), []).append(file)
            seen[file] += 1
    if not layouts:
        return spark.createDataFrame([], schema)
    parts = []
    for (header, _), group in layouts.items():
        position = {name: i for i, name in enumerate(header.split(options.delimiter))}
        named = [position.get(name) for name in schema.fieldNames()]
        rows = _marked(spark.read.text([_literal(f) for f in group])).where(~F.col("begins_file"))
        parts.append(_cells(rows, schema, named, options))
    return union_all(parts)
