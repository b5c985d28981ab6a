import math
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import features as ft
from millrace.operators import joins
from millrace.plans import mart


def column(spark, values, kind="double", name="input"):
    return spark.createDataFrame(list(enumerate(values)), f"id int, {name} {kind}")


def apply(df, feature, places=None):
    rows = ft.fit_transform(df, {"out": feature}, ["id"], ["id"]).orderBy("id").collect()
    got = [r["out"] for r in rows]
    return got if places is None else [None if v is None else round(v, places) for v in got]


#: Water levels of a made-up river, in centimetres against a mark, and the weather of the same days.
LEVELS = [(i * 37) % 23 - 7 for i in range(41)]
WEATHER = [("fog", "rain", "sun")[i % 3 if i % 4 else 1] for i in range(41)]


def close(got, want):
    assert [v is None for v in got] == [v is None for v in want]
    assert all(v is None or math.isclose(v, w, rel_tol=1e-9, abs_tol=1e-9) for v, w in zip(got, want))


def between(values, share):
    """The percentile that lies between two neighbours of the sorted values."""
    ordered = sorted(values)
    place = share * (len(ordered) - 1)
    low = int(place)
    return ordered[low] + (place - low) * (ordered[min(low + 1, len(ordered) - 1)] - ordered[low])


def test_bool_to_one_hot(spark):
    flags = [i % 5 == 0 if i % 7 else None for i in range(30)]
    df = spark.createDataFrame(list(enumerate(flags)), "id int, flooded boolean")
    got = ft.fit_transform(df, {"x": ft.bool_to_one_hot(["flooded"])}).orderBy("id")
    assert got.columns == ["id", "flooded", "is_flooded"] and [r[2] for r in got.collect()] == [int(bool(f)) for f in flags]
    ones = ft.fit_transform(df, {"x": ft.bool_to_one_hot(["flooded"], True, "one_")}).orderBy("id")
    assert [r["one_flooded"] for r in ones.collect()] == [int(f is not False) for f in flags]


def test_categorical_impute(spark):
    gaps = [None if i % 6 == 5 else w for i, w in enumerate(WEATHER)]
    usual = statistics.mode(sorted(g for g in gaps if g))
    assert apply(column(spark, gaps, "string"), ft.categorical_impute("input")) == [g or usual for g in gaps]
    assert apply(column(spark, ["sun", "fog", None], "string"), ft.categorical_impute("input")) == ["sun", "fog", "fog"]
    assert apply(column(spark, [None], "string"), ft.categorical_impute("input")) == [None]
    with pytest.raises(ValueError):
        ft.categorical_impute("input", "mean")


@pytest.mark.parametrize("base", [None, 3, 0.5])
def test_exponentiate(spark, base):
    feature = ft.exponentiate("input") if base is None else ft.exponentiate("input", base)
    close(apply(column(spark, [v / 4 for v in LEVELS]), feature), [(base or math.e) ** (v / 4) for v in LEVELS])


def test_interact(spark):
    pairs = [(v, w % 4) for v, w in zip(LEVELS, reversed(LEVELS))]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id int, a int, b int")
    assert apply(df, ft.interact("a", "b")) == [a * b for a, b in pairs]
    assert apply(df, ft.interact("a", "b", "additive")) == [a + b for a, b in pairs]
    assert apply(df, ft.interact("a", "b", "exponential")) == [a**b for a, b in pairs]
    with pytest.raises(ValueError):
        ft.interact("a", "b", "divisive")


def test_k_bins(spark):
    df = column(spark, LEVELS, "int")
    low, high = min(LEVELS), max(LEVELS)
    # Bins of 7, 7, 7, 7, 7 and 6 rows in the order of level and key.
    order = sorted(range(len(LEVELS)), key=lambda i: (LEVELS[i], i))
    quantile = {i: place // 7 + 1 for place, i in enumerate(order)}
    assert apply(df, ft.k_bins_discretize("input", 6)) == [quantile[i] for i in range(len(LEVELS))]
    uniform = [(v - low) * 3 // (high - low) + 1 for v in LEVELS]
    assert apply(df, ft.k_bins_discretize("input", 4, "uniform")) == uniform and set(uniform) == {1, 2, 3, 4}
    # Without a key the bins still have their sizes.
    got = ft.fit_transform(df, {"bin": ft.k_bins_discretize("input", 6)}, keep=["input"])
    sizes = {r["bin"]: r["count"] for r in got.groupBy("bin").count().collect()}
    assert sizes == {1: 7, 2: 7, 3: 7, 4: 7, 5: 7, 6: 6}
    # Nor does a key that repeats change them.
    repeated = df.withColumn("half", F.floor(F.col("id") / 2))
    got = ft.fit_transform(repeated, {"bin": ft.k_bins_discretize("input", 6)}, ["half"])
    assert {r["bin"]: r["count"] for r in got.groupBy("bin").count().collect()} == sizes
    assert got.columns == ["id", "input", "half", "bin"]
    assert apply(column(spark, [4, 4], "int"), ft.k_bins_discretize("input", 5, "uniform")) == [None, None]
    for bad in (dict(k=0), dict(k=1, strategy="uniform"), dict(k=3, strategy="odd")):
        with pytest.raises(ValueError):
            ft.k_bins_discretize("input", **bad)
    with pytest.raises(ValueError):
        ft.fit(df, {"bin": ft.k_bins_discretize("input", 5)})


def test_label_encode(spark):
    gaps = [None if i % 9 == 4 else w for i, w in enumerate(WEATHER)]
    codes = {w: i for i, w in enumerate(sorted(set(WEATHER)))}
    assert apply(column(spark, gaps, "string"), ft.label_encode("input")) == [codes.get(g, len(codes)) for g in gaps]


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_label_encode_of_many_values(spark, monkeypatch, max_bytes):
    if max_bytes is not None:
        monkeypatch.setattr(joins.lookup, "__defaults__", (None, max_bytes))
    df = column(spark, [None if i % 7 == 0 else (i * 37) % 1500 for i in range(3000)], "int")
    got = ft.fit_transform(df, {"out": ft.label_encode("input")})
    want = df.withColumn("want", F.dense_rank().over(Window.orderBy(F.col("input").asc_nulls_last())) - 1)
    assert got.join(want, "id").where("out <> want").count() == 0 and got.count() == 3000
    assert got.columns == ["id", "input", "out"]


@pytest.mark.parametrize("base, offset", [(10, 0), (2, 3), (math.e, 7.5)])
def test_log_transform(spark, base, offset):
    want = [math.log(v + offset, base) if v + offset > 0 else None for v in LEVELS]
    close(apply(column(spark, [*map(float, LEVELS), None]), ft.log_transform("input", base=base, offset=offset)), [*want, None])


def test_scales(spark):
    df = column(spark, LEVELS, "int")
    low, high = min(LEVELS), max(LEVELS)
    close(apply(df, ft.max_absolute_scale("input")), [v / max(map(abs, LEVELS)) for v in LEVELS])
    close(apply(df, ft.min_max_scale("input")), [(v - low) / (high - low) for v in LEVELS])
    close(apply(df, ft.min_max_scale("input", -3, 5)), [8 * (v - low) / (high - low) - 3 for v in LEVELS])
    for middle in (0.5, 0.8):
        unit = between(LEVELS, 0.5 + middle / 2) - between(LEVELS, 0.5 - middle / 2)
        close(apply(df, ft.robust_scale("input", middle)), [(v - between(LEVELS, 0.5)) / unit for v in LEVELS])
    mean, spread = statistics.mean(LEVELS), statistics.stdev(LEVELS)
    close(apply(df, ft.standardize("input")), [(v - mean) / spread for v in LEVELS])
    close(apply(df, ft.standardize("input", 100, 15)), [15 * (v - mean) / spread + 100 for v in LEVELS])


def test_constant_or_empty_columns_scale_to_null(spark):
    for values in ([3.0, 3.0], [None, None]):
        df = column(spark, values)
        for make in (ft.min_max_scale, ft.robust_scale, ft.standardize):
            assert apply(df, make("input")) == [None, None]
    assert apply(column(spark, [0.0, -0.0]), ft.max_absolute_scale("input")) == [None, None]


def test_numerical_binarize(spark):
    df = column(spark, [*LEVELS, None], "int")
    assert apply(df, ft.numerical_binarize("input", 4, "value")) == [*(int(v >= 4) for v in LEVELS), 0]
    border = between(LEVELS, 0.7)
    assert apply(df, ft.numerical_binarize("input", 0.7, direction=">")) == [*(int(v > border) for v in LEVELS), 0]
    assert apply(df, ft.numerical_binarize("input", 0.7, direction="<=")) == [*(int(v <= border) for v in LEVELS), 0]
    with pytest.raises(ValueError):
        ft.numerical_binarize("input", 0.2, direction="like")


@pytest.mark.parametrize("options, fill", [
    ((), statistics.mean), (("median",), statistics.median), (("percentile", 0.9), lambda v: between(v, 0.9)),
    (("percentile", 1.0), max), (("median", 0.9), statistics.median),
])
def test_numerical_impute(spark, options, fill):
    gaps = [None if i % 8 == 3 else v for i, v in enumerate(LEVELS)]
    want = fill([v for v in gaps if v is not None])
    close(apply(column(spark, gaps, "int"), ft.numerical_impute("input", *options)), [want if v is None else v for v in gaps])


def test_numerical_impute_by_an_unknown_measure():
    with pytest.raises(ValueError):
        ft.numerical_impute("input", "mode")


def test_one_hot_encode(spark):
    gaps = [None if i % 9 == 4 else w for i, w in enumerate(WEATHER)]
    df = column(spark, gaps, "string", "sky")
    got = ft.fit_transform(df, {"x": ft.one_hot_encode("sky")}).orderBy("id")
    assert got.columns[2:] == ["is_sky__fog", "is_sky__rain", "is_sky__sun", "is_sky__"]
    assert [tuple(r)[2:] for r in got.collect()] == [tuple(int(g == w) for w in ("fog", "rain", "sun", None)) for g in gaps]
    some = ft.fit_transform(df, {"x": ft.one_hot_encode("sky", source_condition="sky <> 'rain'")})
    assert some.columns[2:] == ["is_sky__fog", "is_sky__sun", "is_sky__"]
    given = ft.fit_transform(df, {"x": ft.one_hot_encode("sky", categories=["sun", "light rain"])})
    assert given.columns[2:] == ["is_sky__sun", "is_sky__light_rain", "is_sky__"]
    with pytest.raises(ValueError):
        ft.fit_transform(df, {"x": ft.one_hot_encode("sky", categories=["light rain", "light-rain"])})


@pytest.mark.parametrize("degree", [3, 0.5, -1])
def test_poly_transform(spark, degree):
    values = [v + 8 for v in LEVELS]
    close(apply(column(spark, values, "int"), ft.poly_transform("input", degree)), [v**degree for v in values])


@pytest.mark.parametrize("on_driver", [1000, 1])
def test_rare_category_encode(spark, monkeypatch, on_driver):
    monkeypatch.setattr(ft, "DRIVER_VALUES", on_driver)
    values = [*WEATHER, "hail", "hail", "snow", None]
    got = apply(column(spark, values, "string"), ft.rare_category_encode("input", 0.05))
    assert got == ["Other" if v in ("hail", "snow") else v for v in values]


@pytest.mark.parametrize("observed", [True, False])
def test_random_impute(spark, observed):
    values = [None if i % 3 == 0 else float(i % 5) for i in range(300)]
    df = column(spark, values)
    first = ft.random_impute(df, "input", ["id"], consider_distribution=observed)
    again = ft.random_impute(df.repartition(7), "input", ["id"], consider_distribution=observed)
    got = {r["id"]: r["input"] for r in first.collect()}
    assert got == {r["id"]: r["input"] for r in again.collect()} and len(got) == 300
    assert all(v is None or got[i] == v for i, v in enumerate(values))
    assert set(got.values()) == {0.0, 1.0, 2.0, 3.0, 4.0}
    other = ft.random_impute(df, "input", ["id"], seed=1, consider_distribution=observed)
    assert got != {r["id"]: r["input"] for r in other.collect()}
    empty = ft.random_impute(column(spark, [None, None]), "input", consider_distribution=observed)
    assert [r["input"] for r in empty.collect()] == [None, None]


def test_fitted_features_apply_to_new_rows(spark):
    fitted = ft.fit(column(spark, [0.0, 10.0]), {"scaled": ft.min_max_scale("input"), "half": ft.numerical_binarize("input", 0.5)})
    got = fitted.transform(column(spark, [5.0, 20.0])).orderBy("id").collect()
    assert [(r["scaled"], r["half"]) for r in got] == [(0.5, 1), (2.0, 1)]


def test_same_column_twice_is_refused(spark):
    df = spark.createDataFrame([(True,)], "a boolean")
    with pytest.raises(ValueError):
        ft.fit_transform(df, {"x": ft.bool_to_one_hot(["a"]), "y": ft.bool_to_one_hot(["a"])})


def test_mart_transform_is_a_projection(spark):
    """With the facts known the mart neither shuffles nor sorts its rows."""
    rows = [(i, float(i % 9), float(i % 4), float(i), 1.0 + i % 2, "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, kind string")
    numeric = ["a", "b", "c", "d"]
    got = mart.feature_mart(df, numeric, "kind", ["id"])
    assert len(got.columns) == 4 + 1 + 4 * 8 + 6 * 2 + 1 + 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert got.count() == 60
