import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, joins, reshape
from millrace.sources import series


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_deduplicate_limits_each_key_before_the_shuffle(spark):
    readings = [(station, f"level {day * 7 % 5}", day) for station in range(6) for day in range(station + 1)]
    df = spark.createDataFrame(readings, "station int, reading string, day int")
    got = reshape.deduplicate(df, ["station"], [F.desc("day")])
    assert rows(got) == [(station, f"level {station * 7 % 5}", station) for station in range(6)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pivot(spark):
    catch = [("lake", "perch"), ("lake", "perch"), ("lake", "pike"), ("river", "fisher's eel"), ("river", "pike"), ("sea", None)]
    df = spark.createDataFrame(catch, "water string, fish string")
    got = df.groupBy("water").agg(*aggregates.pivot("fish", ["perch", "pike"]))
    assert got.columns == ["water", "perch", "pike"] and rows(got) == [("lake", 2, 1), ("river", 0, 1), ("sea", 0, 0)]
    got = df.groupBy("water").agg(*aggregates.pivot("fish", ["pike", "fisher's eel"], quote_identifiers=False))
    assert got.columns[1] == "pike" and "'" not in got.columns[2] and rows(got) == [("lake", 1, 0), ("river", 1, 1), ("sea", 0, 0)]
    distinct = df.groupBy("water").agg(*aggregates.pivot("fish", ["pike"], agg="count", cmp="!=", distinct=True, prefix="n_"))
    # Rows that are not pike give 1 and all others 0, also the one without a fish, so there are up to two values to count.
    assert rows(distinct) == [("lake", 2), ("river", 2), ("sea", 1)]
    with pytest.raises(ValueError):
        aggregates.pivot("color", ["red"], cmp="~")


def test_unpivot(spark):
    boats = [(i, f"2023-0{i}-15", ("moored", "at sea")[i % 2], i * 2.5, f"crew {i}") for i in range(1, 8)]
    df = spark.createDataFrame(boats, "boat int, seen_on string, state string, length double, crew string")
    got = reshape.unpivot(df, exclude=["BOAT", "seen_on"], remove=["crew"], field_name="prop", value_name="val")
    assert got.columns == ["boat", "seen_on", "prop", "val"]
    assert rows(got) == sorted([(b, d, *x) for b, d, state, length, _ in boats for x in (("state", state), ("length", str(length)))], key=str)
    flags = spark.createDataFrame([(i, (True, None, False)[i % 3]) for i in range(9)], "id int, leaking boolean")
    assert [r["value"] for r in reshape.unpivot(flags, exclude=["id"]).orderBy("id").collect()] == ["true", None, "false"] * 3


def test_union_relations(spark):
    ponds = spark.createDataFrame([(i, f"pond {i}", f"{i}.5 m") for i in range(4)], "id int, name string, depth string")
    wells = spark.createDataFrame([(i, "stone", 10 * i) for i in range(3)], "id int, wall string, depth int")
    tables = {"ponds": ponds, "wells": wells}
    got = reshape.union_relations(tables)
    assert got.columns == ["_source_relation", "id", "name", "depth", "wall"]
    assert rows(got) == sorted(
        [("ponds", i, f"pond {i}", f"{i}.5 m", None) for i in range(4)] + [("wells", i, None, str(10 * i), "stone") for i in range(3)], key=str)
    assert "name" not in reshape.union_relations(tables, exclude=["NAME"]).columns
    assert reshape.union_relations(tables, include=["Id"], source_column_name=None).columns == ["id"]
    assert reshape.union_relations(tables, where="id = 3").count() == 1
    assert dict(reshape.union_relations(tables, column_override={"ID": "bigint"}).dtypes)["id"] == "bigint"
    for bad in ({"include": ["id"], "exclude": ["id"]}, {"include": ["nothing"]}):
        with pytest.raises(ValueError):
            reshape.union_relations(tables, **bad)


def test_column_values(spark):
    df = spark.createDataFrame([(c,) for c in ["reed"] * 3 + ["moss", "fern", "moss", "alga"]], "field string")
    assert reshape.get_column_values(df, "field", at_most=4) == ["reed", "moss", "alga", "fern"]
    assert reshape.get_column_values(df, "field", order_by=["value"], max_records=2) == ["alga", "fern"]
    assert reshape.get_column_values(df, "field", where="field > 'moss'", at_most=4) == ["reed"]
    assert reshape.get_column_values(None, "field", default=["x"]) == ["x"]
    assert reshape.get_column_values(df.where("false"), "field", default=["x"], at_most=7) == ["x"]
    with pytest.raises(ValueError):
        reshape.get_column_values(None, "field")
    with pytest.raises(ValueError):
        reshape.get_column_values(spark.range(2000), "id", at_most=1999)


def test_values_on_the_driver(spark):
    df = spark.createDataFrame([(10, "oak", None), (20, "elm", True), (30, "ash", False)], "height int, tree string, bare boolean").coalesce(1)
    assert reshape.get_query_results_as_dict(df, max_rows=3) == {"height": [10, 20, 30], "tree": ["oak", "elm", "ash"], "bare": [None, True, False]}
    with pytest.raises(ValueError):
        reshape.get_query_results_as_dict(df, max_rows=2)
    assert reshape.get_single_value(df.select("tree")) == "oak"
    assert reshape.get_single_value(df.where("false"), default=7) == 7


def test_symmetric_difference_with_and_without_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(reshape.symmetric_difference(a, b)) == [("a_minus_b", 2), ("b_minus_a", 3)]
    assert rows(reshape.symmetric_difference(a, b, keep_duplicates=True)) == [("a_minus_b", 1), ("a_minus_b", 2), ("b_minus_a", 3)]


def test_group_concat(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, "b"), (2, None)], "g int, t string")
    assert rows(aggregates.group_concat(df, ["g"], "t", "all")) == [(1, "a, b, b"), (2, None)]
    assert rows(aggregates.group_concat(df, ["g"], "t", "all", "|", distinct=True)) == [(1, "a|b"), (2, None)]


def test_group_concat_parts(spark):
    df = spark.createDataFrame([(i % 2, f"t{i:03d}") for i in range(100)] * 2 + [(5, None)], "g int, t string")
    parts = aggregates.group_concat_parts(df, ["g"], "t", "texts", part_rows=7)
    joined = {}
    for r in parts.orderBy("g", "part").collect():
        assert len(r["texts"].split(", ")) <= 7
        joined[r["g"]] = ", ".join(filter(None, [joined.get(r["g"]), r["texts"]]))
    whole = aggregates.group_concat(df, ["g"], "t", "texts", distinct=True)
    assert {**joined, 5: None} == {r["g"]: r["texts"] for r in whole.collect()}


def test_group_by_first_and_frequencies(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)], "x string, y string, v int")
    assert rows(aggregates.group_by_first(df, 2).agg(F.sum("v"))) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]
    assert rows(aggregates.frequencies(df, "x")) == [("a", 2, 0.5), ("c", 2, 0.5)]
    assert aggregates.most_frequent(df, "x") == "a"
    assert aggregates.most_frequent(df.where("false"), "x") is None


def test_series(spark):
    assert [r[0] for r in series.generate_series(spark, 10).orderBy(F.col("generated_number")).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        series.generate_series(spark, 0)
    days = series.date_spine(spark, "day", "2023-12-20", "2024-03-05")
    assert days.columns == ["date_day"] and days.count() == 76 and str(days.agg(F.max("date_day")).first()[0])[:10] == "2024-03-04"
    months = [str(r[0])[:10] for r in series.date_spine(spark, "month", "2024-01-31", "2024-05-01").orderBy("date_month").collect()]
    assert months == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]
    with pytest.raises(ValueError):
        series.date_spine(spark, "day", "2024-03-05", "2023-12-20")
    assert [r[0] for r in series.multiply(series.generate_numbers(spark, 3), 10).orderBy("number").collect()] == [10, 20, 30]


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_lookup_by_broadcast_and_by_split(spark, max_bytes):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else ("hot" if i % 2 else f"k{i}")) for i in range(400)], "id int, k string")
    counts = df.groupBy("k").count().withColumn("code", F.length("k"))
    got = joins.lookup(df, counts, "k", count="count", max_bytes=max_bytes)
    assert got.columns == ["id", "k", "code"] and got.count() == 400
    assert got.where(~F.col("code").eqNullSafe(F.length("k"))).count() == 0


def test_anti_and_semi(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k int")
    keys = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows(joins.anti(left, keys, "k")) == [(1,), (3,), (None,)]
    assert rows(joins.semi(left, keys, "k")) == [(2,), (2,)]
    assert "LeftAnti" in joins.anti(left, keys, "k")._jdf.queryExecution().optimizedPlan().toString()


def test_signed_difference_repeats_rows_in_parts(spark, monkeypatch):
    monkeypatch.setattr(reshape, "REPEAT_ROWS", 7)
    a = spark.createDataFrame([(1, "x")] * 50 + [(2, None)] * 3 + [(None, "y")], "a int, b string")
    b = spark.createDataFrame([(1, "x")] * 8 + [(2, None)] * 24 + [(3, "z")], "a int, b string")
    got = reshape.symmetric_difference(a, b, keep_duplicates=True).groupBy("which_diff", "a", "b").count().collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("a_minus_b", 1, "x", 42), ("a_minus_b", None, "y", 1), ("b_minus_a", 2, None, 21), ("b_minus_a", 3, "z", 1)], key=str)


def test_a_text_too_long_for_a_cell_is_an_error_before_it_is_made(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "LONGEST_TEXT", 15)
    df = spark.createDataFrame([(1, "abc")] * 4 + [(2, "abc")] * 2, "g int, t string")
    with pytest.raises(Exception, match="does not fit"):
        aggregates.group_concat(df, ["g"], "t", "texts").collect()
    short = aggregates.group_concat(df.where("g = 2"), ["g"], "t", "texts").collect()
    assert [r.texts for r in short] == ["abc, abc"]
    assert [r.texts for r in aggregates.group_concat(df.where("g = 2"), [], "t", "texts").collect()] == ["abc, abc"]
