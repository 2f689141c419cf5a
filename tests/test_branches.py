import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.plans.predicates import RequiredFilterError, at
from tablespan.plans.scan import scan
from tablespan.plans.tables import Table, UnknownVersionError, Version, VersionedTable

from tablespan.sources.branches import (
    format_branch,
    frame_branch,
    function_branch,
    scan_function,
    table_branch,
)
from tablespan.sources.sequences import range_of, sequence, split_sequence

LABELLED = T.StructType().add("n", T.LongType()).add("label", T.StringType())


def text(folder, name, content):
    path = folder / name
    path.write_bytes(content.encode())
    return str(path)


def text_table(paths, schema=LABELLED, **options):
    return Table("t", (format_branch("csv", paths, options),), schema)


def test_pinned_text_file(spark, tmp_path):
    path = text(tmp_path, "f.csv", "n|label\n0|row_0\n1|row_1\n2|row_2\n3|row_3\n4|row_4\n")
    table = text_table([path], delim="|", header=True, nullstr="row_2")
    rows = scan(spark, table).orderBy("n").collect()
    assert [r.n for r in rows] == [0, 1, 2, 3, 4]
    assert [r.label for r in rows] == ["row_0", "row_1", None, "row_3", "row_4"]


def test_header_names_decide_per_file(spark, tmp_path):
    one = text(tmp_path, "one.csv", "n,label\n1,a\n")
    two = text(tmp_path, "two with space.csv", "label,extra,n\nb,x,2\nlabel,x,3\n")
    three = text(tmp_path, "three.csv", "other,n\nx,4\n")
    rows = scan(spark, text_table([one, two, three, one], header=True)).collect()
    found = sorted((r.n, r.label) for r in rows if r.label) + [r for r in rows if not r.label]
    assert found == [(1, "a"), (1, "a"), (2, "b"), (3, "label"), Row(n=4, label=None)]


def test_blank_lines_and_short_rows_are_rows(spark, tmp_path):
    path = text(tmp_path, "f.csv", "1,a\n\n2\n,b\n3,c,surplus\n")
    rows = scan(spark, text_table([path])).collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (None, None), (2, None), (None, "b"), (3, "c")]


def test_empty_text_stays_when_a_null_text_is_named(spark, tmp_path):
    path = text(tmp_path, "f.csv", "1,\n2,none\n")
    rows = scan(spark, text_table([path], nullstr="none")).collect()
    assert [r.label for r in rows] == ["", None]


def test_quotes_and_pattern_characters_mean_nothing(spark, tmp_path):
    path = text(tmp_path, "f.csv", '1."a\n2.b"\n')
    rows = scan(spark, text_table([path], delim=".")).collect()
    assert [r.label for r in rows] == ['"a', 'b"']


@pytest.mark.parametrize("delim", ["\t", "^", "\\", "_", " ", "$", "*", "x", "§", "\x01", '"', "'"])
@pytest.mark.parametrize("header", [True, False])
def test_any_single_character_delimits(spark, tmp_path, delim, header):
    first = f"n{delim}label\n" if header else ""
    path = text(tmp_path, "f.csv", f"{first}1{delim}a{delim}\n2{delim}{delim}b\n")
    rows = scan(spark, text_table([path], delim=delim, header=header)).collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, None)]


def test_empty_and_header_only_files(spark, tmp_path):
    empty, bare = text(tmp_path, "e.csv", ""), text(tmp_path, "h.csv", "n,label\n")
    assert scan(spark, text_table([empty], header=True)).count() == 0
    assert scan(spark, text_table([empty, bare], header=True)).count() == 0
    assert scan(spark, text_table([], header=True)).columns == ["n", "label"]


@pytest.mark.parametrize(
    "kind, cell", [("bigint", "x"), ("bigint", " 5"), ("tinyint", "300"), ("int", "1.5"), ("double", "one")]
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_numbers_raise(spark, tmp_path, kind, cell, ansi):
    path = text(tmp_path, "f.csv", f"{cell}\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        table = text_table([path], T.StructType.fromDDL(f"v {kind}"))
        with pytest.raises(Exception, match="column 'v'"):
            scan(spark, table).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_booleans_never_raise(spark, tmp_path):
    path = text(tmp_path, "f.csv", "TRUE\nTrue\nyes\n1\n\n")
    rows = scan(spark, text_table([path], T.StructType.fromDDL("b boolean"))).collect()
    assert [r.b for r in rows] == [True, True, False, False, None]


def test_text_cannot_become_every_type(spark, tmp_path):
    path = text(tmp_path, "f.csv", "2020-01-01\n")
    with pytest.raises(TypeError, match="column 'd'"):
        scan(spark, text_table([path], T.StructType.fromDDL("d date")))


def test_delimiter_must_be_one_character():
    with pytest.raises(ValueError, match="single character"):
        format_branch("csv", ["f"], {"delim": "||"})
    format_branch("csv", ["f"], {"unknown": 1})


@pytest.mark.parametrize("name", ["parquet", "delta", "iceberg"])
def test_only_csv_is_a_format_branch(name):
    with pytest.raises(ValueError, match=name):
        format_branch(name, ["f"])


def test_headers_of_files_cut_into_many_tasks(spark, tmp_path):
    """Every header goes and every line that merely looks like one stays."""
    body = "".join(f"{i},label\n" if i % 3 else "n,label\n" for i in range(2000))
    paths = [text(tmp_path, f"{i}.csv", "n,label\n" + body) for i in range(3)]
    schema = T.StructType().add("n", T.StringType()).add("label", T.StringType())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = scan(spark, text_table(paths, schema, header=True))
        assert rows.rdd.getNumPartitions() > 6
        assert rows.count() == 6000
        assert rows.where("n = 'n'").count() == 3 * len(range(0, 2000, 3))
        assert rows.where("n = '1'").count() == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_file_names_are_not_patterns(spark, tmp_path):
    paths = [text(tmp_path, name, f"n,label\n{i},x\n") for i, name in enumerate(["a[1].csv", "b{c}.csv", "d e.csv", "a1.csv"])]
    schema = T.StructType.fromDDL("n int, label string")
    folder = scan(spark, text_table([str(tmp_path)], schema, header=True))
    assert sorted(r.n for r in folder.collect()) == [0, 1, 2, 3] and len(paths) == 4


def test_many_files_with_three_headers_need_few_jobs(spark, tmp_path):
    for i in range(120):
        text(tmp_path, f"{i}.csv", ["n,label\n{},x\n", "label,n\nx,{}\n", "n\n{}\n"][i % 3].format(i))
    group = "headers-of-many-files"
    spark.sparkContext.setJobGroup(group, "")
    try:
        rows = scan(spark, text_table([str(tmp_path)], T.StructType.fromDDL("n int, label string"), header=True))
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 6
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r.n for r in rows.collect()) == list(range(120)) and rows.where("label = 'x'").count() == 80


@pytest.mark.parametrize("value", ["false", "true", 1, 0])
def test_header_must_be_a_boolean(value):
    with pytest.raises(ValueError, match="header"):
        format_branch("csv", ["f"], {"header": value})


CELL = st.text(alphabet="ab,|x1", max_size=4)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(CELL, min_size=1, max_size=4), max_size=8), st.sampled_from([None, "", "a"]))
def test_text_against_brute_force(spark, tmp_path_factory, lines, null_text):
    folder = tmp_path_factory.mktemp("text")
    content = "".join("|".join(cells) + "\n" for cells in lines)
    path = text(folder, "f.csv", content)
    schema = T.StructType().add("p", T.StringType()).add("q", T.StringType())

    def cell(cells, i):
        value = cells[i] if i < len(cells) else None
        blank = "" if null_text is None else null_text
        return None if value == blank else value

    expected = []
    for line in content.split("\n")[:-1]:
        cells = line.split("|")
        expected.append((cell(cells, 0), cell(cells, 1)))
    table = text_table([path], schema, delim="|", nullstr=null_text)
    assert [tuple(r) for r in scan(spark, table).collect()] == expected


def test_scan_function_arguments():
    for bad, message in [
        (lambda: scan_function("read_parquet"), "no path"),
        (lambda: scan_function("read_parquet", []), "empty"),
        (lambda: scan_function("read_parquet", ["a", None]), "is null"),
        (lambda: scan_function("read_parquet", 7), "int"),
        (lambda: scan_function("read_csv", "a", header=True), "header"),
        (lambda: scan_function("iceberg_scan", ["a"]), "one table location"),
        (lambda: scan_function("iceberg_scan", "a", other=1), "other"),
        (lambda: scan_function("read_orc", "a"), "unknown scan function"),
    ]:
        with pytest.raises(ValueError, match=message):
            bad()
    scan_function("READ_Parquet", "a")


def test_plain_csv_uses_spark_defaults(spark, tmp_path):
    path = text(tmp_path, "f.csv", "a,b\n1,x\n2,y\n")
    frame = scan(spark, Table("t", (scan_function("read_csv", path),)))
    assert frame.columns == ["_c0", "_c1"] and frame.count() == 3


def test_missing_iceberg_is_explained(spark):
    table = Table("t", (scan_function("iceberg_scan", "/tmp/none", snapshot_from_id=7),))
    with pytest.raises(RuntimeError, match="Iceberg Spark runtime"):
        scan(spark, table)


def test_zero_branches(spark):
    with pytest.raises(ValueError, match="no branches"):
        Table("t", (), LABELLED)
    with pytest.raises(ValueError, match="no branches"):
        Table("t", (), LABELLED, planning="bind")
    empty = scan(spark, Table("t", (), LABELLED, planning="filtered"), where=at("n") > 1)
    assert empty.count() == 0 and len(empty.columns) == 2


def test_two_split_branches(spark):
    schema = T.StructType().add("n", T.LongType())
    table = Table(
        "t", (function_branch(split_sequence, 30, 6), function_branch(split_sequence, 20, 2)), schema
    )
    rows = scan(spark, table)
    assert rows.rdd.getNumPartitions() == 8
    found = rows.agg(F.count("n"), F.sum("n"), F.count_distinct("n"), F.max("n")).first()
    assert tuple(found) == (50, 625, 30, 29)


def test_split_ranges(spark):
    frame = split_sequence(spark, 97, 5).withColumn("bucket", range_of(F.col("n"), 97, 5) % 2)
    counts = {r.bucket: r["count"] for r in frame.groupBy("bucket").count().collect()}
    assert counts == {0: 58, 1: 39}
    few = sequence(spark, 2).select(range_of(F.col("n"), 2, 5).alias("r")).collect()
    assert sorted(r.r for r in few) == [0, 1]


def test_mixed_branches_with_their_own_filters(spark, tmp_path):
    spark.range(5).selectExpr("id AS x", "concat('p', id) AS y").write.parquet(f"{tmp_path}/p")
    path = text(tmp_path, "f.csv", "10,t\n")
    spark.sql("SELECT 20 AS a, 'v' AS b").createOrReplaceTempView("view_branch")
    table = Table(
        "t",
        (
            scan_function("read_parquet", f"{tmp_path}/p").filtered("n >= 3"),
            format_branch("csv", [path]),
            table_branch("view_branch"),
            frame_branch(spark.createDataFrame([(30, "f")], "a int, b string")),
        ),
        LABELLED,
    )
    rows = scan(spark, table, where=at("n") < 30, columns=["label"]).collect()
    assert sorted(r.label for r in rows) == ["p3", "p4", "t", "v"]


def test_day_files(spark, tmp_path):
    for day in range(1, 6):
        frame = spark.range((day - 1) * 10, day * 10).selectExpr(
            f"DATE '2026-10-0{day}' AS event_date", "id AS n"
        )
        frame.write.parquet(f"{tmp_path}/{day}")
    files = [f"{tmp_path}/{day}" for day in range(1, 6)]
    schema = T.StructType.fromDDL("event_date date, n bigint")
    table = Table("days", (scan_function("read_parquet", files),), schema, planning="filtered")
    assert tuple(scan(spark, table).agg(F.count("n"), F.sum("n")).first()) == (50, 1225)
    day = scan(spark, table, where=at("event_date") == dt.date(2026, 10, 2))
    assert sorted(r.n for r in day.collect()) == list(range(10, 20))


def test_guard_on_a_delegated_file_table(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/p")
    source = scan_function("read_parquet", f"{tmp_path}/p")
    table = Table("guarded", (source,), required_filters=((("id",),),))
    with pytest.raises(RequiredFilterError, match="guarded"):
        scan(spark, table)
    assert scan(spark, table, where=at("id") > 2).count() == 2
    assert scan(spark, table, acknowledge_required_filters=True).count() == 5


def test_no_columns_means_all(spark):
    table = Table("t", (frame_branch(spark.createDataFrame([(1, "a")], LABELLED)),), LABELLED)
    assert scan(spark, table, columns=[]).columns == ["n", "label"]
    assert scan(spark, table, columns=["label"]).columns == ["label"]


@pytest.fixture
def history(spark):
    def version(label, rows, ddl, year):
        frame = spark.createDataFrame(rows, ddl)
        return Version(label, Table("v", (frame_branch(frame),), frame.schema), dt.datetime(year, 1, 1))

    named = [(i, n, i / 2) for i, n in enumerate(["alice", "bob", "carol", "dave", "eve"])]
    return VersionedTable(
        "v",
        (
            version("1", [(1,), (2,), (3,)], "id bigint", 2020),
            version("2", named, "id bigint, name string, score double", 2021),
            version("3", [(i, i / 2) for i in range(4)], "id bigint, score double", 2022),
        ),
    )


def test_versions(spark, history):
    assert scan(spark, history).count() == 4
    assert scan(spark, history, version="1").columns == ["id"]
    names = scan(spark, history, version="2").select("name").collect()
    assert [r.name for r in names] == ["alice", "bob", "carol", "dave", "eve"]
    for year, count in ((2020, 3), (2021, 5), (2022, 4)):
        assert scan(spark, history, as_of=dt.datetime(year, 6, 15)).count() == count
    assert scan(spark, history, as_of=dt.datetime(2021, 1, 1, 0, 0, 0, 5)).count() == 5
    with pytest.raises(UnknownVersionError, match="9.9.9"):
        scan(spark, history, version="9.9.9")
    with pytest.raises(UnknownVersionError, match="1999"):
        scan(spark, history, as_of=dt.datetime(1999, 1, 1))
    with pytest.raises(ValueError, match="not both"):
        scan(spark, history, version="1", as_of=dt.datetime(2021, 1, 1))


def test_default_version_and_plain_tables(spark, history):
    pinned = VersionedTable("v", history.versions, default="1")
    assert scan(spark, pinned).count() == 3
    with pytest.raises(ValueError, match="no history"):
        scan(spark, history.versions[0].table, version="1")
