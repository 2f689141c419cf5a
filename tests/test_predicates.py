import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tablespan.plans.predicates import (
    Bounds,
    RequiredFilterError,
    at,
    check_required_filters,
    conjuncts,
)


@pytest.mark.parametrize(
    "predicate, path",
    [
        (at("n") > 3, ("n",)),
        (at("s", "a") == 1, ("s", "a")),
        (at("n").is_null(), ("n",)),
        (at("n").is_not_null(), ("n",)),
        ((at("n") < 1) | (at("n") > 9), ("n",)),
        ((at("n") < 1) | (at("m") > 9), None),
        ((at("n") < 1) | at("n").isin(4), None),
        (at("n") == None, None),  # noqa: E711
        (at("n").isin(1, 2), None),
        (~(at("n") == 1), None),
        (at("n").startswith("a"), None),
        (at("n") == at("m"), None),
        ((at("s", "a") == 1) | (at("s", "b") == 2), None),
    ],
)
def test_what_counts_as_a_filter(predicate, path):
    assert predicate.path() == path


def required(*groups):
    return tuple(tuple(group) for group in groups)


def test_every_group_needs_a_filter():
    both = required([("s", "a")], [("s", "b")])
    check_required_filters("t", both, conjuncts((at("s", "a") == 2) & (at("s", "b") == 20)))
    with pytest.raises(RequiredFilterError, match="s.b"):
        check_required_filters("t", both, conjuncts(at("s", "a") == 2))


def test_one_path_of_a_group_is_enough_and_a_parent_covers_its_children():
    either = required([("a",), ("s", "x", "y")])
    check_required_filters("t", either, [at("a") > 1])
    check_required_filters("t", either, [at("s").is_not_null()])
    check_required_filters("t", either, [at("s", "x").is_not_null()])
    with pytest.raises(RequiredFilterError, match="a or s.x.y"):
        check_required_filters("t", either, [at("s", "z") == 1])
    with pytest.raises(RequiredFilterError):
        check_required_filters("t", required([("s",)]), [at("s", "x") == 1])


def test_no_requirement_means_no_check():
    check_required_filters("t", (), [])


VALUES = st.one_of(st.none(), st.integers(-5, 5))


@st.composite
def predicates(draw, depth=2):
    if depth and draw(st.booleans()):
        left, right = draw(predicates(depth=depth - 1)), draw(predicates(depth=depth - 1))
        return draw(st.sampled_from([left & right, left | right, ~left]))
    value = draw(st.integers(-6, 6))
    n = at("n")
    return draw(
        st.sampled_from(
            [n == value, n != value, n < value, n <= value, n > value, n >= value,
             n.is_null(), n.is_not_null(), n.isin(value, 3), n == None]  # noqa: E711
        )
    )


def holds(predicate, value):
    """SQL's three-valued answer for one value, worked out by hand."""
    kind = type(predicate).__name__
    if kind == "NullTest":
        return (value is None) == predicate.null
    if kind == "Compare":
        if value is None or predicate.value is None:
            return None
        ops = {"=": "__eq__", "<>": "__ne__", "<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}
        return getattr(value, ops[predicate.operator])(predicate.value)
    if kind == "IsIn":
        return None if value is None else value in predicate.values
    if kind == "Not":
        inner = holds(predicate.inner, value)
        return None if inner is None else not inner
    answers = [holds(p, value) for p in predicate.parts]
    decisive = kind == "AnyOf"
    if decisive in answers:
        return decisive
    return None if None in answers else not decisive


@settings(max_examples=400, deadline=None)
@given(st.lists(VALUES, max_size=6), predicates())
def test_skipping_never_loses_a_row(values, predicate):
    present = [v for v in values if v is not None]
    bounds = Bounds(
        min(present, default=None), max(present, default=None), values.count(None), len(values)
    )
    if any(holds(predicate, v) is True for v in values):
        assert predicate.may_hold({("n",): bounds})


def test_skipping_skips():
    known = {("n",): Bounds(10, 20, 0, 5)}
    assert not (at("n") < 10).may_hold(known)
    assert not (at("n") == 21).may_hold(known)
    assert not at("n").is_null().may_hold(known)
    assert not at("n").isin(1, 2).may_hold(known)
    assert (at("n") <= 10).may_hold(known)


def test_doubtful_bounds_keep_the_branch():
    nan = {("x",): Bounds(float("nan"), float("nan"), 0, 3)}
    assert (at("x") > 1.0).may_hold(nan)
    assert (at("x") > "a").may_hold({("x",): Bounds(1, 2, 0, 3)})
    assert (at("y") > 1).may_hold({("x",): Bounds(1, 2, 0, 3)})
    assert (at("x") > 2**53).may_hold({("x",): Bounds(0.5, 1.5, 0, 3)}) is False
    assert (at("x") > 2**53 + 1).may_hold({("x",): Bounds(0.5, 1.5, 0, 3)})


def test_zoneless_moments_compare_without_a_zone(spark):
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType())])
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),)], schema)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        condition = at("ts") == dt.datetime(2024, 1, 1, 12)
        assert frame.where(condition.column(schema)).count() == 1
        assert frame.where(at("ts").isin(dt.datetime(2024, 1, 1, 12)).column(schema)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
