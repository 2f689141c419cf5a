"""Files planned by a manifest, and folders read together."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.plans.predicates import Bounds, at
from tablespan.plans.scan import kept_branches, scan
from tablespan.plans.tables import Table
from tablespan.sources.branches import partitioned_files
from tablespan.sources.manifest import extended, measured_files, with_key_filters

SCHEMA = T.StructType().add("n", T.IntegerType()).add("s", T.StringType()).add("x", T.DoubleType())
SCHEMA = SCHEMA.add("p", T.StructType().add("d", T.DateType())).add("part", T.StringType())


def made(draw, rows):
    texts = [None, "", "a", "ab", "b", "zz", "é"]
    spans = [None, float("nan"), -0.0, 1.5, -3.0, float("inf")]
    days = [None, *(dt.date(2024, 1, d) for d in range(1, 20))]
    return [(draw.choice([None, *range(base := draw.randint(0, 40), base + 5)]), draw.choice(texts), draw.choice(spans), (draw.choice(days),)) for _ in range(rows)]


PREDICATES = [
    at("n") == 7, at("n") != 7, at("n") > 30, at("n") <= 3, at("n").isin(1, 40), at("n").is_null(), at("n").is_not_null(),
    at("s") == "ab", at("s").startswith("a"), at("s").startswith(""), at("s") >= "é", at("x") > 1.0, at("x") == 0.0, at("x") == float("nan"),
    at("p", "d") < dt.date(2024, 1, 3), at("part") == "a b/c", at("part").is_null(), ~(at("n") > 3), (at("n") < 3) | (at("s") == "zz"),
    (at("n") < 9) & at("part").isin("k=1", "[x]*"), at("n") == None, at("n").isin(), at("n") < at("x"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "with space")
    draw = random.Random(8)
    for part in ["a b/c", "k=1", "[x]*", None, "é%20"]:
        for _ in range(3):
            rows = spark.createDataFrame([(*r, part) for r in made(draw, draw.randint(1, 6))], SCHEMA)
            rows.coalesce(1).write.mode("append").partitionBy("part").parquet(path)
    return path


def test_a_manifest_never_loses_a_row(spark, folder):
    paths = [("n",), ("s",), ("x",), ("p", "d"), ("part",)]
    manifest = measured_files(spark, folder, SCHEMA, paths)
    table = Table("t", (manifest.branch(),), SCHEMA)
    plain = spark.read.schema(SCHEMA).parquet(folder)
    assert manifest.files.count() == 15
    assert sorted(map(repr, scan(spark, table).collect())) == sorted(map(repr, plain.collect()))
    skipped = 0
    for where in PREDICATES:
        found = scan(spark, table, where=where)
        want = plain.where(where.column(SCHEMA))
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect())), where
        skipped += 15 - manifest.needed([where]).count()
    assert skipped > 60
    assert {r["values"]["part"] for r in manifest.files.collect()} == {"a b/c", "k=1", "[x]*", "__HIVE_DEFAULT_PARTITION__", "é%20"}


def test_new_files_are_added(spark, tmp_path):
    schema = T.StructType.fromDDL("n int")
    spark.range(10).selectExpr("cast(id AS int) AS n").coalesce(1).write.parquet(f"{tmp_path}/t")
    manifest = measured_files(spark, f"{tmp_path}/t", schema, [("n",)])
    spark.range(10, 20).selectExpr("cast(id AS int) AS n").coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    now = {r["file"] for r in measured_files(spark, f"{tmp_path}/t", schema).files.collect()}
    new = sorted(now - {r["file"] for r in manifest.files.collect()})
    more = extended(spark, manifest, new)
    assert more.files.count() == 2 and more.rows(spark).count() == 20 and manifest.rows(spark).count() == 10
    assert more.needed([at("n") == 15]).count() == 1
    assert extended(spark, manifest, []) is manifest
    assert extended(spark, more, new).files.count() == 2


def test_a_thousand_folders_are_one_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(2000).selectExpr("id AS n", "id % 1000 AS k").repartition(4, "k").write.partitionBy("k").parquet(path)
    schema = T.StructType.fromDDL("n bigint, k bigint")
    manifest = measured_files(spark, path, schema, [("n",), ("k",)])
    start = time.perf_counter()
    rows = scan(spark, Table("t", (manifest.branch(),), schema), where=at("k") < 900)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    took = time.perf_counter() - start
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert rows.agg(F.count("n"), F.max("k")).first() == (1800, 899)
    assert took < 20  # a read and an inference a folder take minutes
    branches = partitioned_files(spark, path, lambda v: {("k",): Bounds(int(v["k"]), int(v["k"]))})
    table = Table("t", branches, T.StructType.fromDDL("n bigint"), planning="filtered")
    assert len(kept_branches(table, [at("k") < 10])) == 10
    rows = scan(spark, table)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert rows.agg(F.count("n"), F.sum("n")).first() == (2000, 1999000)


def test_nothing_is_needed(spark, tmp_path):
    schema = T.StructType.fromDDL("n int, s string")
    spark.createDataFrame([(1, "x")], schema).write.parquet(f"{tmp_path}/t")
    manifest = measured_files(spark, f"{tmp_path}/t", schema, [("n",)])
    rows = scan(spark, Table("t", (manifest.branch(),), schema), where=at("n") > 5)
    assert rows.collect() == [] and rows.columns == ["n", "s"]


def test_row_groups_of_kept_tables_are_bounded(spark):
    from glob import glob

    import pyarrow.parquet as pq

    from tablespan.sources.shared import kept, recorded

    rows = spark.range(0, 64, 1, 1).selectExpr("id", "transform(sequence(0, 19999), x -> xxhash64(x, id)) AS many")
    with recorded() as folders:
        bounded = kept(spark, rows, 1 << 20)
    (file,) = glob(f"{folders[0].removeprefix('file:')}/*.parquet")
    groups = pq.ParquetFile(file).metadata
    most = max(groups.row_group(i).num_rows for i in range(groups.num_row_groups))
    assert most <= 16  # 160 KB a row; the next check is at most 16 rows away
    assert bounded.agg({"id": "sum"}).first()[0] == 64 * 63 // 2


def test_key_filters_never_lose_a_row(spark, folder):
    manifest = with_key_filters(spark, measured_files(spark, folder, SCHEMA, [("x",)]), [("n",), ("s",), ("part",)])
    table = Table("t", (manifest.branch(),), SCHEMA)
    plain = spark.read.schema(SCHEMA).parquet(folder)
    for where in [*PREDICATES, at("s").isin("", "é", None), at("n") == 7.0, at("n") == 1 << 40, [at("n") == 7, at("s") == "ab"]]:
        found, want = scan(spark, table, where=where), plain
        for one in where if isinstance(where, list) else [where]:
            want = want.where(one.column(SCHEMA))
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect())), where


def test_key_filters_choose_files_inside_all_ranges(spark, tmp_path):
    path = str(tmp_path / "keys")
    rows = spark.range(0, 40_000, 1, 4).selectExpr("id AS n", "CAST(id % 16 AS string) AS part")
    rows.repartition("part").write.partitionBy("part").parquet(path)
    schema = T.StructType().add("n", T.LongType()).add("part", T.StringType())
    ranges = measured_files(spark, path, schema, [("n",)])
    keyed = with_key_filters(spark, ranges, [("n",)])
    wrong = 0
    for n in (161, 20_002, 31_999):
        assert ranges.needed([at("n") == n]).count() == 16
        wrong += keyed.needed([at("n") == n]).count() - 1
    assert wrong <= 4  # of 45; about 1 in 100 is expected
    assert keyed.needed([at("n") == 50_000]).count() == 0  # beyond all ranges
    read = scan(spark, Table("t", (keyed.branch(),), schema), where=at("n").isin(16, 160, 16_000))
    assert sorted(r.n for r in read.collect()) == [16, 160, 16_000]
    assert len(read.inputFiles()) < 5


def test_key_filters_grow_with_new_files(spark, tmp_path):
    path = str(tmp_path / "grow")
    schema = T.StructType().add("n", T.IntegerType())
    spark.createDataFrame([(None,), (5,), (9,)], schema).coalesce(1).write.parquet(path)
    keyed = with_key_filters(spark, measured_files(spark, path, schema), [("n",)])
    before = {r["file"] for r in keyed.files.collect()}
    spark.createDataFrame([(7,), (None,)], schema).coalesce(1).write.mode("append").parquet(path)
    files = [f for f in spark.read.parquet(path).inputFiles() if f not in before and f.replace("file:///", "file:/") not in before]
    assert len(files) == 1
    grown = extended(spark, keyed, files)
    assert keyed.needed([at("n") == 7]).count() == 0
    assert grown.needed([at("n") == 7]).count() == grown.needed([at("n") == 5]).count() == 1
    assert grown.needed([]).count() == 2


def test_key_filters_of_empty_files_and_refused_kinds(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], "n int, x double").write.parquet(path)
    schema = T.StructType().add("n", T.IntegerType()).add("x", T.DoubleType())
    keyed = with_key_filters(spark, measured_files(spark, path, schema), [("n",)])
    assert scan(spark, Table("t", (keyed.branch(),), schema), where=at("n") == 1).count() == 0
    with pytest.raises(ValueError, match="double"):
        with_key_filters(spark, keyed, [("x",)])
