"""Comparison by digests, against the comparison of all rows."""

import random

import pytest

from tablespan.operators.compare import frames_diff
from tablespan.operators.digests import added, cells_differ, differing_ranges, digests, rows_differ
from tablespan.queries import QUERIES

SCHEMA = "k long, side_ string, v double, many array<string>"


def made(seed, n=400):
    draw = random.Random(seed)
    values = [None, 0.0, -0.0, float("nan"), 1.5]
    return [
        (draw.choice([None, 7, 7, 7, i]), draw.choice([None, "", "a"]), draw.choice(values), draw.choice([None, [], [None, "x"], ["x", None]]))
        for i in range(n)
    ]


def listed(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_same_report_as_all_rows(spark, seed):
    draw = random.Random(seed)
    rows = made(seed)
    other = [r for r in rows if draw.random() > 0.02] + [(r[0], r[2] and "b", r[2], r[3]) for r in rows if draw.random() < 0.02]
    draw.shuffle(other)
    actual, expected = spark.createDataFrame(other, SCHEMA), spark.createDataFrame(rows, SCHEMA)
    for bits in (1, 10):
        assert listed(rows_differ(actual, expected, ["k"], bits)) == listed(frames_diff(actual, expected))


def test_order_parts_and_signed_zeros_do_not_matter(spark):
    rows = made(9)
    turned = [(k, s, 0.0 if v == 0 else v, m) for k, s, v, m in reversed(rows)]
    one, other = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(turned, SCHEMA)
    parts = added(digests(one.limit(150), ["k"]), digests(one.offset(150), ["k"]))
    assert differing_ranges(digests(other, ["k"]), digests(one, ["k"])).count() == 0
    assert differing_ranges(parts, digests(spark.createDataFrame(rows[:150] + rows[150:], SCHEMA), ["k"])).count() == 0


def test_nulls_have_a_place(spark):
    one = spark.createDataFrame([(1, None, "a", ["x", None])], "k long, a string, b string, c array<string>")
    for row in [(1, "a", None, ["x", None]), (1, None, "a", [None, "x"]), (1, None, "a", None)]:
        other = spark.createDataFrame([row], one.schema)
        assert differing_ranges(digests(one, ["k"]), digests(other, ["k"])).count() == 1


def test_few_ranges_are_compared(spark):
    rows = spark.range(20_000).selectExpr("id AS k", "id % 13 AS v")
    other = rows.selectExpr("k", "IF(k = 4711, 99, v) AS v")
    assert differing_ranges(digests(rows, ["k"]), digests(other, ["k"])).count() == 1
    found = cells_differ(rows_differ(other, rows, ["k"]), ["k"]).collect()
    assert [tuple(r) for r in found] == [(4711, "v", "99", str(4711 % 13), 1, 1)]


def test_cells_of_pairs_and_numbers_of_others(spark):
    schema = "copy long, k long, v string"
    expected = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, None, "z")], schema)
    actual = spark.createDataFrame([(1, 1, ""), (2, 1, "b"), (1, 3, ""), (1, 4, "n"), (1, 4, "n"), (5, None, None)], schema)
    found = cells_differ(rows_differ(actual, expected, ["k"]), ["k"]).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [
            (1, None, None, None, 2, 1),
            (2, None, None, None, 0, 1),
            (3, "v", "(empty)", "NULL", 1, 1),
            (4, None, None, None, 2, 0),
            (None, "copy", "5", "1", 1, 1),
            (None, "v", "NULL", "z", 1, 1),
        ],
        key=repr,
    )


def test_empty_and_refused(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert rows_differ(none, none, ["k"]).count() == 0
    assert rows_differ(none, spark.createDataFrame(made(1, 5), SCHEMA), ["k"]).count() > 0
    for key, bits in ((["x"], 16), ([], 16), (["k"], 0), (["k"], 21)):
        with pytest.raises(ValueError):
            digests(none, key, bits)


def test_stored_groups_need_no_exchange(spark):
    result = QUERIES["key_grouped_stored"](spark, "/root/testdata/sf0.001")
    assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
