"""A manifest of Parquet files: what each file holds, so that a scan opens only files it may need.

The manifest is a small table (a row a file), made once in one job and kept. A scan's
predicates select rows of it, and the files that are left are one read with the
declared schema: no schema is inferred, and the plan does not grow with the folders.

Ranges say little about keys that are spread over all files. For those a manifest can have key filters:
a Bloom filter a file, kept as rows of 64 bits, so that a search reads only the words that it asks for.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.operators.schema import quoted, union_all
from tablespan.plans.predicates import (
    All,
    AnyOf,
    ColumnPath,
    Compare,
    IsIn,
    NullTest,
    Predicate,
    StartsWith,
    balanced,
)
from tablespan.sources.branches import Branch
from tablespan.sources.shared import kept

KEY_HASHES = 4


@dataclass(frozen=True)
class Manifest:
    """``files`` has file, values, rows, bytes, and low_i, high_i, nulls_i for path i of ``paths``.

    ``values`` are the partition values in the file's path. Files without rows are not listed.
    ``keys`` has file, path (a number in ``key_sizes``), word and bits of the key filters.
    """

    folder: str
    schema: T.StructType
    files: DataFrame
    paths: tuple[ColumnPath, ...]
    keys: DataFrame | None = None
    key_sizes: tuple[tuple[ColumnPath, int], ...] = ()

    def needed(self, where: Sequence[Predicate]) -> DataFrame:
        """The rows of files that can hold a row for which every predicate is true."""
        numbers = {path: i for i, path in enumerate(self.paths)}
        conditions = [_possible(p, numbers, self.files.schema) for p in where]
        files = self.files.where(balanced(Column.__and__, conditions)) if conditions else self.files
        for predicate in where:
            holding = self._holding(predicate)
            files = files if holding is None else files.join(holding, "file", "left_semi")
        return files

    def _holding(self, predicate: Predicate) -> DataFrame | None:
        """(file): files whose key filter may have a value that the predicate asks for; ``None`` if it cannot tell."""
        sizes = dict(self.key_sizes)
        asks = isinstance(predicate, IsIn) or (isinstance(predicate, Compare) and predicate.operator == "=")
        if not asks or predicate.on not in sizes:
            return None
        values = [v for v in (predicate.values if isinstance(predicate, IsIn) else [predicate.value]) if v is not None]
        kind = _key_kind(self.schema, predicate.on)
        fits = str if kind == "string" else int
        if not all(type(v) is fits and (fits is str or -(1 << 63) <= v < 1 << 63) for v in values):
            return None
        number = [path for path, _ in self.key_sizes].index(predicate.on)
        # As many rows as the predicate has values, times KEY_HASHES.
        wanted = self.files.sparkSession.createDataFrame(list(enumerate(values)), f"wanted long, v {kind}")
        asked = wanted.select("wanted", F.explode(_key_bits(F.col("v"), sizes[predicate.on])).alias("p")).select("wanted", "p.word", "p.bit").distinct()
        counted = asked.groupBy("wanted").agg(F.count(F.lit(1)).alias("n"))
        words = [r["word"] for r in asked.select("word").distinct().collect()]
        own = self.keys.where((F.col("path") == number) & F.col("word").isin(words))
        hits = own.join(F.broadcast(asked), "word").where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
        hits = hits.groupBy("file", "wanted").agg(F.count(F.lit(1)).alias("hits"))
        return hits.join(F.broadcast(counted), "wanted").where("hits = n").select("file")

    def rows(self, spark: SparkSession, where: Sequence[Predicate] = ()) -> DataFrame:
        """The rows of the needed files in one read; the driver gets their names."""
        names = [_path(r["file"]) for r in self.needed(where).select("file").collect()]
        if not names:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.schema(self.schema).option("basePath", self.folder)
        return reader.parquet(*names).select(*[F.col(quoted(n)) for n in self.schema.names])

    def branch(self) -> Branch:
        """The files as a branch whose scans are planned by the manifest."""
        return Branch(f"manifest({self.folder})", lambda spark, _schema: self.rows(spark), plan=self.rows)


def measured_files(
    spark: SparkSession, folder: str, schema: T.StructType, paths: Sequence[ColumnPath] = ()
) -> Manifest:
    """The manifest of all Parquet files under a folder, in one job that reads the columns of ``paths``.

    Columns of ``schema`` that are partition values come from the files' paths. Make it anew
    when files have come or gone, or add rows for new files with :func:`extended`.
    """
    found = _measured(spark.read.schema(schema).parquet(folder), paths)
    return Manifest(folder, schema, kept(spark, found), tuple(paths))


def extended(spark: SparkSession, manifest: Manifest, files: Sequence[str]) -> Manifest:
    """The manifest with further files; only those are read."""
    if not files:
        return manifest
    rows = spark.read.schema(manifest.schema).option("basePath", manifest.folder).parquet(*files)
    more = kept(spark, _measured(rows, manifest.paths))
    known = manifest.files.join(more.select("file"), "file", "left_anti")
    grown = replace(manifest, files=kept(spark, known.unionByName(more)))
    if manifest.keys is None:
        return grown
    words = manifest.keys.join(more.select("file"), "file", "left_anti").unionByName(_key_words(rows, manifest))
    return replace(grown, keys=kept(spark, words.sortWithinPartitions("path", "word")))


def with_key_filters(spark: SparkSession, manifest: Manifest, paths: Sequence[ColumnPath], value_bits: int = 10) -> Manifest:
    """The manifest with a filter of the values of each path in each file, for ``=`` and ``isin``.

    Columns are whole numbers or texts. A path's filters have one size, about ``value_bits`` a value for the
    file with the most different ones (about 1 % of files are then read in vain, fewer of smaller files);
    only words with a bit are kept. One job counts, one reads the columns again and combines words in each task.
    """
    rows = spark.read.schema(manifest.schema).parquet(manifest.folder)
    several = [F.approx_count_distinct(_key_value(manifest.schema, p)).alias(f"n{i}") for i, p in enumerate(paths)]
    by_file = rows.select("*", F.col("_metadata.file_path").alias("tablespan_file")).groupBy("tablespan_file").agg(*several)
    most = by_file.agg(*[F.max(f"n{i}").alias(f"n{i}") for i in range(len(paths))]).first()
    sizes = tuple((p, 1 << max(6, (value_bits * (most[f"n{i}"] or 0)).bit_length())) for i, p in enumerate(paths))
    sized = replace(manifest, key_sizes=sizes)
    return replace(sized, keys=kept(spark, _key_words(rows, sized).sortWithinPartitions("path", "word")))


def _key_kind(schema: T.StructType, path: ColumnPath) -> str:
    kind: T.DataType = schema
    for part in path:
        kind = kind[part].dataType
    if isinstance(kind, T.IntegralType):
        return "bigint"
    if isinstance(kind, T.StringType):
        return "string"
    raise ValueError(f"a key filter needs whole numbers or texts, not {kind.simpleString()}")


def _key_value(schema: T.StructType, path: ColumnPath) -> Column:
    return F.col(".".join(quoted(p) for p in path)).cast(_key_kind(schema, path))


def _key_bits(value: Column, size: int) -> Column:
    """The places of a value in a filter of `size` bits, a power of two: (word, bit) for each hash."""
    places = [F.xxhash64(F.lit(i), value).bitwiseAND(F.lit(size - 1)) for i in range(KEY_HASHES)]
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(F.lit(63)).cast("int"))
    return F.array(*[F.struct(F.shiftright(p, 6).alias("word"), bit(p).alias("bit")) for p in places])


def _key_words(rows: DataFrame, manifest: Manifest) -> DataFrame:
    """(file, path, word, bits) of the rows' filters."""
    found = []
    for i, (path, size) in enumerate(manifest.key_sizes):
        value = _key_value(manifest.schema, path)
        named = rows.where(value.isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.explode(_key_bits(value, size)).alias("p"))
        words = named.groupBy("file", "p.word").agg(F.bit_or("p.bit").alias("bits"))
        found.append(words.select("file", F.lit(i).alias("path"), "word", "bits"))
    return union_all(found)


def _measured(rows: DataFrame, paths: Sequence[ColumnPath]) -> DataFrame:
    values = [F.col(".".join(quoted(p) for p in path)).alias(f"v{i}") for i, path in enumerate(paths)]
    named = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), *values)
    measures = [F.count(F.lit(1)).alias("rows"), F.first("bytes").alias("bytes")]
    for i in range(len(paths)):
        value = F.col(f"v{i}")
        measures += [F.min(value).alias(f"low_{i}"), F.max(value).alias(f"high_{i}"), F.count_if(value.isNull()).alias(f"nulls_{i}")]
    parts = F.filter(F.split(F.url_decode("file"), "/"), lambda p: p.contains("="))
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1), F.url_decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1))))
    return named.groupBy("file").agg(*measures).withColumn("values", F.map_from_entries(pairs))


def _path(uri: str) -> str:
    """A file's address as Spark reads it: decoded, with the characters of patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _possible(predicate: Predicate, numbers: Mapping[ColumnPath, int], schema: T.StructType) -> Column:
    """Whether some row of a manifest row's file can satisfy the predicate, over the manifest's columns.

    A file's range is NULL only if all its values are, and then no comparison holds in it.
    """
    again = lambda p: _possible(p, numbers, schema)
    unknown = F.lit(True)
    if isinstance(predicate, All):
        return balanced(Column.__and__, [again(p) for p in predicate.parts])
    if isinstance(predicate, AnyOf):
        return balanced(Column.__or__, [again(p) for p in predicate.parts])
    if not isinstance(predicate, (Compare, IsIn, NullTest, StartsWith)) or predicate.on not in numbers:
        return unknown
    i = numbers[predicate.on]
    low, high, nulls = (f"low_{i}",), (f"high_{i}",), F.col(f"nulls_{i}")
    test = lambda on, sign, value: F.coalesce(Compare(on, sign, value).column(schema), F.lit(False))
    if isinstance(predicate, NullTest):
        return nulls > 0 if predicate.null else nulls < F.col("rows")
    if isinstance(predicate, StartsWith):
        n = len(predicate.prefix)
        first, last = (F.substring(F.col(side[0]), 1, n) for side in (low, high))
        return F.coalesce((first <= predicate.prefix) & (last >= predicate.prefix), F.lit(False))
    if isinstance(predicate, IsIn):
        return balanced(Column.__or__, [again(Compare(predicate.on, "=", v)) for v in predicate.values]) if predicate.values else F.lit(False)
    sign, value = predicate.operator, predicate.value
    if value is None:
        return F.lit(False)
    if sign == "=":
        return test(low, "<=", value) & test(high, ">=", value)
    if sign == "<>":
        return test(low, "<>", value) | test(high, "<>", value)
    return test(low if sign in ("<", "<=") else high, sign, value)
