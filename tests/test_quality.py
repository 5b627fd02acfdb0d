import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality as Q


def n(check):
    return check.failures.count()


def test_accepted_range(spark):
    df = spark.createDataFrame([(i,) for i in range(-1, 12)] + [(None,)], "id int")
    assert n(Q.accepted_range(df, "id", -1, 11)) == 0
    assert n(Q.accepted_range(df, "id", 0, 10)) == 2
    assert n(Q.accepted_range(df, "id", -1, 11, inclusive=False)) == 2
    assert n(Q.accepted_range(df, "id", min_value=0, where="id < 5")) == 1


def test_at_least_one(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "g string, v int")
    assert n(Q.at_least_one(df, "v")) == 0
    assert n(Q.at_least_one(df, "v", group_by=["g"])) == 1
    empty = spark.createDataFrame([], "g string, v int")
    assert n(Q.at_least_one(empty, "v")) == 1            # empty fails ungrouped
    assert n(Q.at_least_one(empty, "v", group_by=["g"])) == 0  # passes grouped


def test_cardinality_and_counts(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (2,)], "y int")
    assert n(Q.cardinality_equality(a, "x", b, "y")) == 4
    assert n(Q.cardinality_equality(a, "x", a, "x")) == 0
    ch = Q.equal_rowcount(a, b)
    assert ch.failures.agg(ch.count_expr()).collect()[0][0] == 0
    ch = Q.fewer_rows_than(a, b)  # equal counts -> 1
    assert ch.failures.agg(ch.count_expr()).collect()[0][0] == 1
    c = spark.createDataFrame([(1,)] * 5, "x int")
    ch = Q.fewer_rows_than(a, c)
    assert ch.failures.agg(ch.count_expr()).collect()[0][0] == 0


def test_equality_precision_and_columns(spark):
    a = spark.createDataFrame([(1, 1.001, "x"), (2, 2.0, "y")], "id int, f double, ign string")
    b = spark.createDataFrame([(1, 1.0, "z"), (2, 2.0, "y")], "id int, f double, ign string")
    assert n(Q.equality(a, b)) == 2
    assert n(Q.equality(a, b, exclude_columns=["ign"], precision=2)) == 0
    assert n(Q.equality(a, b, compare_columns=["id", "F"], precision=3)) == 2
    with pytest.raises(ValueError):
        Q.equality(a, b, compare_columns=["id"], exclude_columns=["f"])


def test_expression_and_assert_equal(spark):
    df = spark.createDataFrame([(1, 2), (3, 3), (None, 1)], "a int, b int")
    assert n(Q.expression_is_true(df, "a < b")) == 1      # NULL passes
    assert n(Q.expression_is_true(df, "< 10", column_name="a")) == 0
    assert n(Q.assert_equal(df, "a", "b")) == 1


def test_mutually_exclusive_ranges(spark):
    ok = spark.createDataFrame([(0, 1), (1, 5), (5, 9)], "lo int, hi int")
    assert n(Q.mutually_exclusive_ranges(ok, "lo", "hi")) == 0
    assert n(Q.mutually_exclusive_ranges(ok, "lo", "hi", gaps="required")) == 2
    gap = spark.createDataFrame([(0, 1), (2, 5)], "lo int, hi int")
    assert n(Q.mutually_exclusive_ranges(gap, "lo", "hi", gaps="not_allowed")) == 1
    overlap = spark.createDataFrame([("a", 0, 3), ("a", 2, 5), ("b", 0, 3), ("b", 0, 3), ("b", 4, 4)],
                                    "p string, lo int, hi int")
    f = Q.mutually_exclusive_ranges(overlap, "lo", "hi", partition_by="p").failures
    # a: (0,3) overlaps next; b: duplicate (0,3) overlaps itself, (4,4) zero length
    assert f.count() == 3
    split = Q.mutually_exclusive_ranges(overlap, "lo", "hi", partition_by="p", rows_per_range=2).failures
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, f.collect()))
    assert n(Q.mutually_exclusive_ranges(overlap.filter("p = 'b'"), "lo", "hi",
                                         zero_length_range_allowed=True)) == 1
    with pytest.raises(ValueError):
        Q.mutually_exclusive_ranges(ok, "lo", "hi", gaps="sometimes")


def test_simple_checks(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", None), ("b", " ", 2), ("c", "", 3)],
                               "g string, s string, v int")
    assert n(Q.not_constant(df, "s", group_by=["g"])) == 3  # each group has one value
    assert n(Q.not_constant(df, "g")) == 0
    assert n(Q.not_accepted_values(df, "g", ["c", "z"])) == 1
    assert n(Q.not_null_proportion(df, "v", at_least=0.8)) == 1
    assert n(Q.not_null_proportion(df, "v", at_least=0.5)) == 0
    assert n(Q.not_empty_string(df, "s")) == 2
    assert n(Q.not_empty_string(df, "s", trim_whitespace=False)) == 1
    assert n(Q.unique_combination_of_columns(df, ["g", "s"])) == 1
    assert n(Q.unique(df, "g")) == 1
    assert n(Q.not_null(df, "v")) == 1
    assert n(Q.accepted_values(df, "g", ["a", "b"])) == 1


def test_relationships(spark):
    child = spark.createDataFrame([(1,), (2,), (4,), (None,)], "id int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert n(Q.relationships(child, "id", parent, "id")) == 1
    assert n(Q.relationships_where(child, "id", parent, "id", from_condition="id <> 4")) == 0
    assert n(Q.relationships_where(child, "id", parent, "id", to_condition="id <> 2")) == 2


def test_recency(spark):
    now = dt.datetime(2024, 1, 10, 12, 0)
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 9, 13, 0)), ("b", dt.datetime(2024, 1, 1))],
                               "g string, ts timestamp_ntz")
    assert n(Q.recency(df, "ts", "day", 1, now=now)) == 0
    assert n(Q.recency(df, "ts", "day", 1, now=now, group_by=["g"])) == 1
    assert n(Q.recency(df.filter("g = 'a'"), "ts", "hour", 12, now=now)) == 1
    assert n(Q.recency(df.filter("g = 'a'"), "ts", "day", 1, now=now, ignore_time_component=True)) == 0


def test_sequential_values(spark):
    ok = spark.createDataFrame([(i,) for i in range(50)], "x int")
    assert n(Q.sequential_values(ok, "x", rows_per_range=2)) == 0
    assert n(Q.sequential_values(ok, "x")) == 0
    bad = spark.createDataFrame([(1,), (2,), (2,), (2,), (4,), (None,)], "x int")
    f = Q.sequential_values(bad, "x", rows_per_range=2).failures
    assert sorted(tuple(r) for r in f.collect()) == [(2, 2), (2, 2), (4, 2)]
    assert n(Q.sequential_values(bad, "x", interval=2)) == 3  # 2 after 1, and the repeated 2s
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3, 5)], "d date")
    assert n(Q.sequential_values(days, "d", datepart="day")) == 1
    grp = spark.createDataFrame([(None, 1), (None, 2), (None, 4), ("a", 7)], "g string, x int")
    assert n(Q.sequential_values(grp, "x", group_by=["g"], rows_per_range=2)) == 1
    assert n(Q.sequential_values(grp, "x", group_by=["g"])) == 1


def test_columns_match_and_suite(spark):
    df = spark.createDataFrame([(1, 2)], "a int, B int")
    assert n(Q.columns_match_set(spark, df, ["A", "b"])) == 0
    assert n(Q.columns_match_set(spark, df, ["a", "c"])) == 2
    suite = Q.run_suite([Q.not_null(df, "a"), Q.accepted_range(df, "a", 5, 9)])
    got = {r.check_name: (r.failures, r.status) for r in suite.collect()}
    assert got == {"not_null": (0, "pass"), "accepted_range": (1, "warn")}


def test_suite_takes_each_checks_own_conditions(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    checks = [Q.not_null(df, "a"), Q.not_null(df, "b"), Q.not_null(df, "b", where="a > 1"), Q.unique(df, "b")]
    checks[0].severity, checks[0].error_if = "error", "> 5"
    checks[1].severity, checks[1].error_if = "error", "> 1"
    checks[3].warn_if = ">= 0"
    got = {r.check_index: (r.failures, r.status) for r in Q.run_suite(checks).collect()}
    assert got == {0: (1, "warn"), 1: (2, "error"), 2: (0, "pass"), 3: (0, "warn")}
