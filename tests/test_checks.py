import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks


def run(check, df, *args, **options):
    return checks.run_check(check, df, *args, **options)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_evaluate_thresholds(spark):
    df = frame(spark, "x int", (1,), (2,), (3,))
    assert checks.evaluate(df) == ("error", 3)
    assert checks.evaluate(df, error_if="> 5") == ("warn", 3)
    assert checks.evaluate(df, error_if="> 5", warn_if="> 3") == ("pass", 3)
    assert checks.evaluate(df.where("false"), "sum(x)") == ("pass", 0)
    assert checks.evaluate(df, error_if="< 1", warn_if="< 1") == ("pass", 3)


def test_accepted_range(spark):
    df = frame(spark, "id double", (-1.0,), (11.0,), (None,))
    assert run(checks.accepted_range, df, "id", -1, 11) == ("pass", 0)
    assert run(checks.accepted_range, df, "id", -2, 11.1, inclusive=False) == ("pass", 0)
    assert run(checks.accepted_range, df, "id", -1, 11, inclusive=False) == ("error", 2)
    assert run(checks.accepted_range, df, "id", 0) == ("error", 1)
    assert run(checks.accepted_range, df, "id", 0, where="id <> -1") == ("pass", 0)
    assert run(checks.accepted_range, df, "id") == ("pass", 0)


def test_at_least_one(spark):
    df = frame(spark, "field string, value int", ("a", 1), ("b", None))
    assert run(checks.at_least_one, df, "field") == ("pass", 0)
    assert [r[0] for r in checks.at_least_one(df, "value", ["field"]).collect()] == ["b"]
    empty = df.where("false")
    assert run(checks.at_least_one, empty, "field") == ("error", 1)
    assert run(checks.at_least_one, empty, "value", ["field"]) == ("pass", 0)


def test_cardinality_equality(spark):
    a = frame(spark, "x int, y int", (1, 2), (2, 3), (3, 1))
    b = frame(spark, "z int", (1,), (2,), (2,))
    assert run(checks.cardinality_equality, a, "x", a, "y") == ("pass", 0)
    # (2, 1) and (3, 1) on one side, (2, 2) on the other.
    assert run(checks.cardinality_equality, a, "x", b, "z") == ("error", 3)


def test_equal_rowcount(spark):
    a = frame(spark, "field int", (1,), (1,), (2,), (None,))
    b = frame(spark, "field int", (1,), (2,), (3,), (None,))
    assert run(checks.equal_rowcount, a, a) == ("pass", 0)
    assert run(checks.equal_rowcount, a, b) == ("pass", 0)
    assert run(checks.equal_rowcount, a, a, ["field"]) == ("pass", 0)
    assert run(checks.equal_rowcount, a, b, ["field"]) == ("error", 2)


def test_fewer_rows_than(spark):
    a = frame(spark, "g int, x int", (1, 1), (1, 2), (1, 3))
    b = frame(spark, "g int, x int", (1, 1), (1, 2), (1, 3), (1, 4))
    assert run(checks.fewer_rows_than, a, b) == ("pass", 0)
    assert run(checks.fewer_rows_than, a, b, ["g"]) == ("pass", 0)
    assert run(checks.fewer_rows_than, a, a) == ("error", 1)
    assert run(checks.fewer_rows_than, b, a.where("x = 1")) == ("error", 3)
    assert run(checks.fewer_rows_than, a, b.withColumn("g", F.lit(2)), ["g"]) == ("error", 3)


def test_equality(spark):
    a = frame(spark, "col_a int, col_b int, col_c int", (1, 1, 3), (1, 2, 1), (2, 3, 3))
    b = frame(spark, "col_a int, col_b int, col_c int", (1, 1, 2), (1, 2, 2), (2, 3, 2))
    assert run(checks.equality, a, b) == ("error", 6)
    assert run(checks.equality, a, b, compare_columns=["col_a", "col_b"]) == ("pass", 0)
    assert run(checks.equality, a, b, exclude_columns=["COL_C"]) == ("pass", 0)
    twice = a.unionAll(a)
    assert run(checks.equality, a, twice) == ("pass", 0)
    assert run(checks.equality, a, twice, keep_duplicates=True) == ("error", 6)
    # Two rows against one: two lines and the imbalance between the sides.
    assert run(checks.equality, a.limit(0), a.where("col_a = 1")) == ("error", 4)
    floats = frame(spark, "id string, f double", ("1", 62.3888186)), frame(spark, "id string, f double", ("1", 62.3888187))
    assert run(checks.equality, *floats, precision=4) == ("pass", 0)
    assert run(checks.equality, *floats, precision=8) == ("error", 2)
    with pytest.raises(ValueError):
        checks.equality(a, b, compare_columns=["col_a"], exclude_columns=["col_b"])
    with pytest.raises(ValueError):
        checks.equality(a, b.drop("col_c"))


def test_expression_is_true(spark):
    df = frame(spark, "col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert run(checks.expression_is_true, df, "col_a + col_b = 1") == ("pass", 0)
    assert run(checks.expression_is_true, df, "= 0.5", column_name="col_b") == ("error", 3)
    assert run(checks.expression_is_true, df, F.col("col_a") < 1) == ("error", 1)


def test_mutually_exclusive_ranges(spark):
    check = checks.mutually_exclusive_ranges
    # Ranges that touch are without gaps; each of them moved apart leaves one, moved together an overlap.
    touching = [(10 * i, 10 * i + 10) for i in range(6)]
    solid = frame(spark, "lo int, hi int", *touching)
    assert run(check, solid, "lo", "hi", gaps="not_allowed") == ("pass", 0)
    assert run(check, solid, "lo", "hi", gaps="required") == ("error", 5)
    apart = frame(spark, "lo int, hi int", *[(lo, hi - 1) for lo, hi in touching])
    for rule, result in (("allowed", ("pass", 0)), ("required", ("pass", 0)), ("not_allowed", ("error", 5))):
        assert run(check, apart, "lo", "hi", gaps=rule) == result
    assert run(check, frame(spark, "lo int, hi int", *[(lo, hi + 1) for lo, hi in touching]), "lo", "hi") == ("error", 5)
    assert run(check, frame(spark, "lo int, hi int", (8, 5)), "lo", "hi") == ("error", 1)
    # Rooms are booked for themselves; an open end is an expression.
    d = dt.date.fromisoformat
    booked = frame(
        spark, "room string, start date, stop date", ("east", d("2023-05-01"), d("2023-05-04")), ("east", d("2023-05-10"), None),
        ("west", d("2023-05-02"), d("2023-05-11")), ("west", d("2023-05-11"), d("2023-05-12")),
    )
    until = "coalesce(stop, date'2030-01-01')"
    assert run(check, booked, "start", until, "room", "allowed") == ("pass", 0)
    assert run(check, booked, "start", until, "room", "not_allowed") == ("error", 1)
    assert run(check, booked, "start", until, "room", "required") == ("error", 1)
    # A NULL bound fails its row.
    assert run(check, booked, "start", "stop", "room") == ("error", 1)
    empty = frame(spark, "g int, a int, b int", *[(g, a, a + (a + g) % 2) for g in (1, 2) for a in (20, 22, 25)])
    assert run(check, empty, "a", "b", "g", zero_length_range_allowed=True) == ("pass", 0)
    assert run(check, empty, "a", "b", "g") == ("error", 3)
    # A NULL lower bound sorts last, so the range before it has no bound to meet.
    assert run(check, frame(spark, "lo int, hi int", (0, 1), (None, 2)), "lo", "hi") == ("error", 2)
    copies = frame(spark, "lo int, hi int", (0, 2), (0, 2), (0, 2), (2, 3))
    assert run(check, copies, "lo", "hi") == ("error", 2)
    with pytest.raises(ValueError):
        check(solid, "lo", "hi", gaps="some")


def test_not_accepted_values(spark):
    df = frame(spark, "colour string", *[(c,) for c in ["red", "blue", "blue", "blue", None]])
    assert run(checks.not_accepted_values, df, "colour", ["green", "grey"]) == ("pass", 0)
    assert run(checks.not_accepted_values, df, "colour", ["blue", "green"]) == ("error", 1)
    assert run(checks.not_accepted_values, df, "colour", ["concat('r', 'ed')", "lower('BLUE')"], quote=False) == ("error", 2)


def test_not_constant(spark):
    df = frame(spark, "g int, field int", (1, 1), (1, 1), (1, 2))
    assert run(checks.not_constant, df, "field") == ("pass", 0)
    assert run(checks.not_constant, df, "field", ["g"]) == ("pass", 0)
    assert run(checks.not_constant, df, "g") == ("error", 1)
    nulls = frame(spark, "x int", (None,), (None,))
    assert run(checks.not_constant, nulls, "x") == ("pass", 0)


def test_not_empty_string(spark):
    df = frame(spark, "t string", ("text",), ("  text ",), ("   ",), ("",), (None,))
    assert run(checks.not_empty_string, df, "t") == ("error", 2)
    assert run(checks.not_empty_string, df, "t", trim_whitespace=False) == ("error", 1)


def test_not_null_proportion(spark):
    df = frame(spark, "g int, half int, most int", *[(i % 2, i if i < 5 else None, None if i == 3 else i) for i in range(10)])
    assert run(checks.not_null_proportion, df, "half", 0.5, 0.5) == ("pass", 0)
    assert run(checks.not_null_proportion, df, "most", 0.9) == ("pass", 0)
    assert run(checks.not_null_proportion, df, "most", 0.95) == ("error", 1)
    assert run(checks.not_null_proportion, df, "most", 0.9, group_by_columns=["g"]) == ("error", 1)


def test_recency(spark):
    t = dt.datetime(2024, 5, 2)
    df = frame(spark, "g int, at timestamp_ntz", (1, t), (2, t - dt.timedelta(days=9)))
    now = "2024-05-03 13:00:00"
    assert run(checks.recency, df, "at", "day", 1, now) == ("error", 1)
    assert run(checks.recency, df, "at", "day", 1, now, ignore_time_component=True) == ("pass", 0)
    assert [r["g"] for r in checks.recency(df, "at", "day", 2, now, group_by_columns=["g"]).collect()] == [2]
    empty = df.where("false")
    assert run(checks.recency, empty, "at", "day", 1, now) == ("pass", 0)
    assert run(checks.recency, empty, "at", "day", 1, now, fail_if_empty=True) == ("error", 1)


def test_relationships_where(spark):
    parents, children = frame(spark, "id int", (1,), (2,), (3,)), frame(spark, "id int", (1,), (2,), (4,), (4,), (None,))
    assert run(checks.relationships_where, children, "id", parents, "id") == ("error", 2)
    assert run(checks.relationships_where, children, "id", parents, "id", from_condition="id <> 4") == ("pass", 0)
    assert run(checks.relationships_where, children, "id", parents, "id", "id <> 4", "id > 1") == ("error", 1)


def test_unique_combination_and_builtins(spark):
    df = frame(spark, "m string, p string", ("jan", "a"), ("jan", "b"), ("feb", "a"), (None, "a"))
    assert run(checks.unique_combination_of_columns, df, ["m", "p"]) == ("pass", 0)
    assert run(checks.unique_combination_of_columns, df.unionAll(df), ["m", "p"]) == ("error", 4)
    assert run(checks.unique, df, "p") == ("error", 1)
    assert run(checks.unique, df.unionAll(df.where("m is null")), "m") == ("error", 1)
    assert run(checks.not_null, df, "m") == ("error", 1)
    assert run(checks.accepted_values, df, "m", ["jan", "feb"]) == ("pass", 0)
    assert run(checks.accepted_values, df, "m", ["jan"]) == ("error", 1)


def test_sequential_values(spark):
    df = frame(spark, "g int, even int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10))
    assert run(checks.sequential_values, df, "even", 2, group_by_columns=["g"]) == ("pass", 0)
    assert run(checks.sequential_values, df, "even", 2) == ("pass", 0)
    assert run(checks.sequential_values, df, "even") == ("error", 4)
    # Two copies of 4 follow themselves, and 6 follows 4 as it should.
    assert run(checks.sequential_values, df.unionAll(df.where("even = 4")).unionAll(df.where("even = 4")), "even", 2) == ("error", 2)
    hours = frame(spark, "at timestamp_ntz", *[(dt.datetime(2024, 1, 1, h),) for h in (0, 1, 2, 3)])
    assert run(checks.sequential_values, hours, "at", 1, "hour") == ("pass", 0)
    assert run(checks.sequential_values, hours.where("hour(at) <> 1"), "at", 1, "hour") == ("error", 1)


def test_columns_match_set(spark):
    df = frame(spark, "a int, B int", (1, 2))
    assert run(lambda d: checks.columns_match_set(spark, d, ["A", "b"]), df) == ("pass", 0)
    got = checks.columns_match_set(spark, df, ["a", "c"]).collect()
    assert [tuple(r) for r in got] == [("B", "table"), ("C", "list")]
    assert run(lambda d: checks.columns_match_set(spark, d, ["A", "b"], case_folded=False), df) == ("error", 4)


def test_assertions(spark):
    df = frame(spark, "a double, b double", (1.0, 1.00001), (2.0, 2.5), (None, None), (None, 1.0))
    assert run(checks.assert_equal, df, "a", "b") == ("error", 3)
    assert run(checks.assert_equal, df, "a", "b", tolerance=1e-4) == ("error", 2)
    assert run(checks.assert_close, df, "a", "b") == ("error", 2)
    assert run(checks.assert_not_null, df, "a") == ("error", 2)
    assert run(checks.assert_equal_string, df, "a", "b") == ("error", 3)


def test_checks_together_agree_with_each_alone(spark, tmp_path):
    rows = [(i if i % 9 else None, i % 4, float(i % 50), None if i == 3 else i % 7) for i in range(200)] + [(5, 1, 99.0, 1)] * 3
    df = spark.createDataFrame(rows, "a int, b int, x double, c int")
    together = checks.check_together(df, {
        "a": checks.not_null_rule("a"), "a from 50": checks.not_null_rule("a", where="x > 20", error_if="> 1000"),
        "x": checks.range_rule("x", 1, 49), "x open": checks.range_rule("x", 0, 99, inclusive=False), "true": checks.true_rule("c < 6"),
        "key": checks.unique_rule(["a"]), "pair": checks.unique_rule(["a", "b"], nulls=True), "values": checks.values_rule("c", [0, 1, 2]),
        "values too": checks.values_rule("c", list(range(7))),
    })
    alone = {
        "a": checks.run_check(checks.not_null, df, "a"), "a from 50": checks.run_check(checks.not_null, df, "a", where="x > 20", error_if="> 1000"),
        "x": checks.run_check(checks.accepted_range, df, "x", 1, 49), "x open": checks.run_check(checks.accepted_range, df, "x", 0, 99, inclusive=False),
        "true": checks.run_check(checks.expression_is_true, df, "c < 6"), "key": checks.run_check(checks.unique, df, "a"),
        "pair": checks.run_check(checks.unique_combination_of_columns, df, ["a", "b"]), "values": checks.run_check(checks.accepted_values, df, "c", [0, 1, 2]),
        "values too": checks.run_check(checks.accepted_values, df, "c", list(range(7))),
    }
    assert together == alone and together["values too"] == ("pass", 0) and together["a from 50"][0] == "warn"
    assert checks.check_together(df.limit(0), {"a": checks.not_null_rule("a"), "key": checks.unique_rule(["a"])}) == {"a": ("pass", 0), "key": ("pass", 0)}
    with pytest.raises(ValueError):
        checks.values_rule("c", [1], where="x > 1")
