"""The distributed forms against the literal one-task windows on small data."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        # A third of all rows share one value, some are NULL, some negative zero.
        x = 5.0 if i % 3 == 0 else rng.choice([None, -0.0, 0.0, float(rng.randint(-50, 50)), rng.random()])
        rows.append((i, "hot" if i % 3 else rng.choice("abc"), x))
    return spark.createDataFrame(rows, "id long, g string, x double").repartition(6)


def test_row_numbers_match_literal_window(skewed):
    got = ordering.row_numbers(skewed, ["g", "id"])
    want = skewed.withColumn("want", F.row_number().over(Window.orderBy("g", "id")) - 1)
    assert got.join(want, ["id"]).where("row_index <> want").count() == 0
    assert got.count() == 3000


@pytest.mark.parametrize("k", [1, 4, 7, 5000])
def test_global_ntile_matches_literal_window(skewed, k):
    got = ordering.global_ntile(skewed, k, ["id"])
    want = skewed.withColumn("want", F.ntile(k).over(Window.orderBy("id")))
    assert got.join(want, ["id"]).where("tile <> want").count() == 0


@pytest.mark.parametrize("k", [1, 5, 8, 4000])
def test_ntile_borders_match_literal_window(skewed, k):
    df = skewed if k < 4000 else skewed.where("id < 90")
    k = k if k < 4000 else 100
    borders = ordering.column_ranks(df, {}, {"x": [k]}, ["id"])[1]["x", k]
    got = df.withColumn("tile", ordering.ntile_column(df, "x", borders, ["id"]))
    clean = df.withColumn("x", F.col("x") + F.lit(0.0))
    want = clean.select("id", F.ntile(k).over(Window.orderBy(F.col("x").asc_nulls_last(), "id")).alias("want"))
    assert got.join(want, "id").where("tile <> want").count() == 0


def test_percentiles_match_builtin(skewed):
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = ordering.percentiles(skewed, {"x": shares, "id": [0.5]})
    want = skewed.agg(F.percentile("x", shares)).first()[0]
    for p, w in zip(shares, want):
        assert got["x", p] == pytest.approx(w)
    assert got["id", 0.5] == pytest.approx(1499.5)


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert ordering.percentiles(empty, {"x": [0.5]}) == {("x", 0.5): None}


def test_dense_codes_put_null_last(skewed):
    rows = ordering.dense_codes(skewed, "x").collect()
    by_value = {r["x"]: r["code"] for r in rows}
    ordered = sorted(v for v in by_value if v is not None)
    assert [by_value[v] for v in ordered] == list(range(len(ordered)))
    assert by_value[None] == len(ordered)


@pytest.mark.parametrize("ahead", [False, True])
@pytest.mark.parametrize("group", [[], ["g"]])
def test_neighbour_matches_literal_window(skewed, ahead, group):
    got = ordering.neighbour(skewed, group, ["id"], "x", "n", ahead)
    w = Window.partitionBy(*group).orderBy("id")
    fn = F.lead if ahead else F.lag
    want = skewed.select("id", fn("x").over(w).alias("want"), fn("id").over(w).isNotNull().alias("there"))
    wrong = got.join(want, "id").where(~F.col("n").eqNullSafe(F.col("want")) | (F.col("n_exists") != F.col("there")))
    assert wrong.count() == 0 and got.count() == 3000


@pytest.mark.parametrize("short", [0, 10**9])
def test_ties_are_split_by_a_key_of_several_columns(spark, monkeypatch, short):
    monkeypatch.setattr(ordering, "SHORT_RUN", short)
    rows = [(1.0 if i % 4 else None, None if i % 6 == 0 else i % 3, f"s{i % 10}", i) for i in range(600)]
    df = spark.createDataFrame(rows, "x double, a int, b string, c int").repartition(5)
    key = ["a", "b", "c"]
    borders = ordering.column_ranks(df, {}, {"x": [7, 3]}, key)[1]
    for k in (7, 3):
        got = df.withColumn("tile", ordering.ntile_column(df, "x", borders["x", k], key))
        want = got.withColumn("want", F.ntile(k).over(Window.orderBy(F.col("x").asc_nulls_last(), *key)))
        assert want.where("tile <> want").count() == 0
    with pytest.raises(ordering.DuplicateKey):
        ordering.column_ranks(df, {}, {"x": [7]}, ["a", "b"])


def test_long_runs_are_split_without_ranging_them(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SHORT_RUN", 100)
    ranged, real = [], ordering._ranged

    def counted(df, order):
        written = real(df, order)
        ranged.append(written.rows.count())
        return written

    monkeypatch.setattr(ordering, "_ranged", counted)
    # Three values of x, and a key that is NULL in some rows.
    df = spark.range(30_000).selectExpr("id % 3 * 1.5 as x", "if(id % 50 = 0, null, (id * 7919) % 30011) as a", "id as b").repartition(5)
    borders = ordering.column_ranks(df, {}, {"x": [7]}, ["a", "b"])[1]["x", 7]
    got = df.withColumn("tile", ordering.ntile_column(df, "x", borders, ["a", "b"]))
    want = got.withColumn("want", F.ntile(7).over(Window.orderBy("x", "a", "b")))
    assert want.where("tile <> want").count() == 0
    assert sum(ranged) < 3000


@pytest.mark.parametrize("fan, parts", [(2, 13), (3, 40)])
def test_prefixes_over_many_levels(spark, monkeypatch, fan, parts):
    monkeypatch.setattr(ordering, "FAN", fan)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 3000).selectExpr("id", "id % 2 as g", "if(id % 3 = 0, null, id * 2) as x").repartition(7)
        got = ordering.row_numbers(df, ["g", "id"]).withColumn("want", F.row_number().over(Window.orderBy("g", "id")) - 1)
        assert got.where("row_index <> want").count() == 0 and got.count() == 3000
        for ahead in (False, True):
            shift = F.lead if ahead else F.lag
            got = ordering.neighbour(df, ["g"], ["id"], "x", "n", ahead)
            want = got.withColumn("want", shift("x").over(Window.partitionBy("g").orderBy("id")))
            assert want.where("not (n <=> want)").count() == 0
            assert got.where("not n_exists").count() == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _sorted(values):
    return sorted(values, key=lambda v: (v is None, v != v, v if v is not None and v == v else 0))


@pytest.mark.parametrize("kind", ["double", "long", "decimal(30,2)", "int"])
def test_ranked_values_match_a_sort(spark, kind):
    import random

    draw = random.Random(kind)
    values = [draw.choice([None, 7, 7, draw.randint(-10**6, 10**6), draw.randint(0, 40)]) for _ in range(4000)]
    if kind == "double":
        values += [float("nan")] * 40 + [float("inf"), float("-inf"), -0.0, 0.0] * 9
        values = [None if v is None else float(v) for v in values]
    elif kind in ("long", "decimal(30,2)"):
        values = [None if v is None else v + 2**53 for v in values]
    df = spark.createDataFrame([(v,) for v in values], f"x {'double' if kind == 'double' else 'long'}").withColumn("x", F.col("x").cast(kind)).repartition(6)
    order = _sorted(values)
    present = sum(v is not None for v in values)
    wanted = sorted({0, 1, 17, 999, 1000, 2500, present - 1, present, len(values) - 1})
    n, m, found = ordering.ranked_values(df, {"x": lambda n, present: wanted})["x"]
    assert (n, m) == (len(values), present)
    for rank in wanted:
        value, before, equal = found[rank]
        same = [i for i, v in enumerate(order) if v == order[rank] or (v is not None and v != v and order[rank] is not None and order[rank] != order[rank])]
        assert (before, equal) == (same[0], len(same))
        assert (value is None) == (order[rank] is None) and (value is None or float(value) == float(order[rank]) or value != value)


def test_a_bracket_that_misses_its_rank_is_widened(spark, monkeypatch):
    off = lambda steps, present, wanted: [ordering.Bracket(10.0, 12.0, sorted(wanted))]
    monkeypatch.setattr(ordering, "_brackets", off)
    df = spark.range(500).selectExpr("double(id) as x")
    found = ordering.ranked_values(df, {"x": lambda n, present: [3, 11, 400]})["x"][2]
    assert found == {3: (3.0, 3, 1), 11: (11.0, 11, 1), 400: (400.0, 400, 1)}


@pytest.mark.parametrize("kind", ["double", "long"])
def test_a_thousand_tiles(spark, kind):
    rows = [(None if i % 11 == 0 else i % 700, None if i % 5 == 0 else i % 9, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "x long, a int, b int").withColumn("x", F.col("x").cast(kind)).repartition(5)
    borders = ordering.column_ranks(df, {}, {"x": [1000]}, ["a", "b"])[1]["x", 1000]
    got = df.withColumn("tile", ordering.ntile_column(df, "x", borders, ["a", "b"]))
    want = got.withColumn("want", F.ntile(1000).over(Window.orderBy(F.col("x").asc_nulls_last(), "a", "b")))
    assert want.where("tile <> want").count() == 0


def test_written_tables_lie_in_the_shared_folder(spark):
    import os

    from millrace import session

    written = session.write_once(spark.range(5))
    path = written.path.removeprefix("file:")
    assert written.path.startswith(session.shared_folder(spark)) and os.path.isdir(path)
    assert written.rows.count() == 5
    written.delete()
    assert not os.path.exists(path)
    before = set(os.listdir(os.path.dirname(path)))
    ordering.percentiles(spark.range(50).selectExpr("double(id) x"), {"x": [0.5]})
    assert set(os.listdir(os.path.dirname(path))) == before
