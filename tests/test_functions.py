import itertools

import pytest
from pyspark.sql import functions as F

from millrace.functions import arithmetic, columns, dates, geo, keys, urls
from millrace.functions.names import slugify


def values(df, *cols):
    return [tuple(r) if len(cols) != 1 else r[0] for r in df.select(*cols).collect()]


def every(spark, schema, *choices):
    """All combinations of the choices, in the order of the rows."""
    rows = list(itertools.product(*choices))
    return rows, spark.createDataFrame(rows, schema)


def test_safe_add_and_subtract(spark):
    rows, df = every(spark, "a int, b int, c int", [None, -4, 25], [None, 9], [None, 0, 7])
    filled = [[v or 0 for v in r] for r in rows]
    assert values(df, arithmetic.safe_add(["a", "b", "c"])) == [sum(r) for r in filled]
    assert values(df, arithmetic.safe_subtract(["a", "b", "c"])) == [a - b - c for a, b, c in filled]
    for bad in ([], "a"):
        with pytest.raises(ValueError):
            arithmetic.safe_add(bad)
        with pytest.raises(ValueError):
            arithmetic.safe_subtract(bad)


def test_safe_divide(spark):
    over = lambda n, d: None if n is None or not d else n / d
    rows, df = every(spark, "n double, d double", [None, 0.0, -2.5, 12.0], [None, 0.0, 8.0, -0.5])
    assert values(df, arithmetic.safe_divide("n", "d")) == [over(*r) for r in rows]
    rows, df = every(spark, "a int, b int, d int", [None, 1, 11], [0, 4], [None, 0, 3])
    product = lambda a, b: None if a is None else a * b
    assert values(df, arithmetic.safe_divide(F.col("a") * F.col("b"), "d")) == [over(product(a, b), d) for a, b, d in rows]


def test_width_bucket(spark):
    marks = [i / 4 for i in range(-8, 60)]
    df = spark.createDataFrame([(m,) for m in marks], "mark double")
    assert values(df, arithmetic.width_bucket("mark", 0, 12, 5)) == [0 if m < 0 else 6 if m >= 12 else int(m / 2.4) + 1 for m in marks]
    with pytest.raises(ValueError):
        arithmetic.width_bucket("mark", 5, 5, 4)


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)], "a string, b string, c string")
    # Keys that other tools make of these rows.
    assert values(df, keys.generate_surrogate_key(["a"])) == [
        "0cc175b9c0f1b6a831c399e269772661", "0cc175b9c0f1b6a831c399e269772661",
        "f14cc5cdce0420f4a5a6b6d9d7b85f39", "f14cc5cdce0420f4a5a6b6d9d7b85f39"]
    assert values(df, keys.generate_surrogate_key(["a", "b", "c"])) == [
        "7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05", "2fa5491950d66d153d23cfbcfea4e164"]
    empty = spark.createDataFrame([(None,), ("",)], "a string")
    assert len(set(values(empty, keys.generate_surrogate_key(["a"])))) == 2
    assert len(set(values(empty, keys.generate_surrogate_key(["a"], null_as_empty=True)))) == 1


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 90.0), (10.0, 20.0, 10.0, 20.0), (-90.0, 5.0, 90.0, 77.0)], "a double, b double, c double, d double")
    miles, km = (values(df, geo.haversine_distance("a", "b", "c", "d", unit=unit)) for unit in ("mi", "km"))
    # A quarter and a half of a great circle.
    assert miles[1] == km[1] == 0 and abs(km[2] - 2 * km[0]) < 1e-6 and abs(km[0] - 10007.5) < 10
    assert all(abs(k / m - 1.609344) < 1e-3 for m, k in zip(miles, km) if m)
    with pytest.raises(ValueError):
        geo.haversine_distance("a", "b", "c", "d", unit="feet")


# url, host, path
URLS = [
    (f"{scheme}{host}{path}{query}", host, path.removeprefix("/"))
    for scheme in ("", "https://", "http://") for host in ("shop.example.org", "example.net")
    for path in ("/", "/a/b.html", "/x/y/") for query in ("", "?ref=mail", "?ref=mail&page=2")
] + [("example.net?ref=mail", "example.net", "")]


@pytest.mark.parametrize("strict", [False, True])
def test_url_host_and_path(spark, strict):
    df = spark.createDataFrame([(u,) for u, _, _ in URLS], "url string")
    assert values(df, urls.get_url_host("url", strict)) == [h for _, h, _ in URLS]
    paths = values(df, urls.get_url_path("url", strict))
    assert [p for p, (_, _, want) in zip(paths, URLS) if want is not None] == [w for _, _, w in URLS if w is not None]


def test_url_rules_that_differ_when_strict(spark):
    df = spark.createDataFrame([("http://me@host.org:80/a?xutm=1#t", )], "url string")
    assert values(df, urls.get_url_host("url")) == ["me@host.org:80"]
    assert values(df, urls.get_url_host("url", strict=True)) == ["host.org"]
    assert values(df, urls.get_url_parameter("url", "utm")) == ["1#t"]
    assert values(df, urls.get_url_parameter("url", "utm", strict=True)) == [None]


def test_url_parameter(spark):
    df = spark.createDataFrame([("https://example.org/list?page=3",), ("https://example.org/list?page=12&sort=name",), ("example.org?page=&sort=1",), (None,)], "url string")
    assert values(df, urls.get_url_parameter("url", "page")) == ["3", "12", None, None]
    assert values(df, urls.get_url_parameter("url", "sort")) == [None, "name", "1", None]


@pytest.mark.parametrize("name, slug", [("", ""), (None, ""), ("Unit Price (EUR)", "unit_price_eur"), ("3rd floor", "_3rd_floor"), ("left - - right", "left_right")])
def test_slugify(name, slug):
    assert slugify(name) == slug


def test_star_and_nullcheck(spark):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "field_1 string, field_2 string, field_3 int")
    assert df.select(*columns.star(df, ["FIELD_3"])).columns == ["field_1", "field_2"]
    assert df.select(*columns.star(df, ["field_3"], "p_", "_s")).columns == ["p_field_1_s", "p_field_2_s"]
    assert df.alias("t").select(*columns.star(df, relation_alias="t")).columns == df.columns
    assert columns.star(df, df.columns) == []
    assert [tuple(r) for r in columns.nullcheck_table(df).collect()] == [("a", None, 1), (None, "b", 2), (None, None, 3)]


def test_dates(spark):
    df = spark.sql("select timestamp_ntz'2024-01-31 10:00:00' a, timestamp_ntz'2024-03-01 09:00:00' b")
    assert str(values(df, dates.dateadd("month", 1, "a"))[0]) == "2024-02-29 10:00:00"
    assert values(df, dates.datediff("month", "a", "b")) == [2]
    assert values(df, dates.datediff("day", "a", "b")) == [30]
    assert str(values(df, dates.last_day("b"))[0]) == "2024-03-31"
    assert str(values(df, dates.month_start("a"))[0]) == "2024-01-01"
    assert values(df, dates.overdue_days("a", "b", 20)) == [9]
    assert values(df, dates.overdue_days("a", "b", 90)) == [0]
    with pytest.raises(ValueError):
        dates.dateadd("fortnight", 1, "a")
