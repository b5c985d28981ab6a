import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import checks, textsearch
from millrace.plans import mart, run, staging, training
from millrace.sinks import versions
from millrace.sinks import tables as sinks
from millrace.sources import catalog, files, synthetic


def pages(folder, *contents):
    folder.mkdir(parents=True)
    for i, content in enumerate(contents):
        (folder / f"sales_{i}.json").write_text(json.dumps(content, indent=2))
    return str(folder)


SALES = [
    {"client": "buyer 1", "purchase_date": "2022-08-09", "product": "kettle", "price": 31},
    {"client": "buyer 2", "purchase_date": "2022-08-09", "product": "lamp", "price": 58},
]


def test_staging_replaces_only_its_date(spark, tmp_path):
    stg = str(tmp_path / "stg")
    stage = lambda raw, date: staging.stage_sales(spark, raw, stg, date, format="parquet")
    raw = pages(tmp_path / "a", SALES, SALES[:1])
    (tmp_path / "a" / "notes.txt").write_text("not a page")
    for _ in range(2):
        stage(raw, "2022-08-09")
    stage(pages(tmp_path / "b", SALES[:1]), "2022-08-10")
    read = lambda: {str(r["date"]): r["count"] for r in spark.read.parquet(stg).groupBy("date").count().collect()}
    assert read() == {"2022-08-09": 3, "2022-08-10": 1}
    stage(pages(tmp_path / "c", []), "2022-08-09")
    assert read() == {"2022-08-10": 1}


def test_staging_refuses_bad_input(spark, tmp_path):
    stage = lambda raw, date="2022-08-09": staging.stage_sales(spark, raw, str(tmp_path / "s"), date, format="parquet")
    for content in ([{"message": "gone"}], [dict(SALES[0], price="dear")]):
        with pytest.raises(Exception):
            stage(pages(tmp_path / f"bad{len(str(content))}", content))
    with pytest.raises(ValueError):
        stage("x", "09-08-2022")
    with pytest.raises(ValueError):
        stage("x", "")
    with pytest.raises(ValueError):
        stage("")
    assert staging.catch_up("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_csv_and_seed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text('id,code,note\n1,007,""\n2,008,x\n')
    seed = files.read_seed(spark, str(path), {"CODE": "string"})
    assert [tuple(r) for r in seed.orderBy("id").collect()] == [(1, "007", None), (2, "008", "x")]
    assert dict(files.read_csv(spark, str(path)).dtypes)["code"] == "int"
    named = files.read_columns(spark, str(path), "a int, b string, c string", ["x", "y", "z"])
    assert named.columns == ["x", "y", "z"] and named.count() == 2
    with pytest.raises(ValueError):
        files.read_seed(spark, str(path), {"other": "int"})
    assert files.with_defaults(seed, {"note": "none"}).where("note = 'none'").count() == 1


def test_rows_and_json_values(spark):
    df = files.read_rows(spark, '[{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]', "a int, b string")
    assert files.describe_rows(df) == {"rows": 2, "columns": ["a", "b"]}
    assert files.read_rows(spark, [{"a": 1}]).columns == ["a"]
    with pytest.raises(ValueError):
        files.read_rows(spark, [])
    doc = spark.createDataFrame([('{"a": {"b": 5}}',), ("broken",)], "doc string")
    assert [r[0] for r in doc.select(files.json_value("doc", "$.a.b", "int")).collect()] == [5, None]
    assert files.read_query(spark, "select 1 as one").collect()[0][0] == 1


def test_tables_views_and_patterns(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS patterns")
    for i in range(3):
        sinks.save_table(spark.range(10 * i, 10 * i + 2).select(F.col("id").alias("reader"), F.lit("opened").alias("what")), f"patterns.events_2018010{i}")
    sinks.save_view(spark.range(1), "events_view")
    names = ["patterns.events_20180100", "patterns.events_20180101", "patterns.events_20180102"]
    assert list(catalog.get_relations_by_prefix(spark, "PATTERNS", "Events_")) == names
    assert list(catalog.get_relations_by_pattern(spark, "pat%", "%0_", exclude="%02")) == names[:2]
    assert catalog.get_relations_by_pattern(spark, "%", "events_view") == {"events_view": "view"}
    both = catalog.union_by_prefix(spark, "patterns", "events_")
    assert both.count() == 6 and both.columns == ["_source_relation", "reader", "what"]
    bound = catalog.Sources(spark, {"analytics.events": names[0]})
    assert bound["analytics.events"].count() == 2
    with pytest.raises(KeyError):
        bound["nothing.here"]
    spark.sql("DROP DATABASE patterns CASCADE")


def test_append_and_materialized_view(spark):
    for name in ("t_results", "t_view"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for hour in (1, 2):
        sinks.append_results(spark.range(2), "t_results", dt.datetime(2024, 1, 1, hour))
    assert spark.table("t_results").groupBy("run_timestamp").count().count() == 2
    n = [2]
    view = sinks.MaterializedView(spark, "t_view", lambda: spark.range(n[0]), key=["id"])
    view.create()
    assert view.read().count() == 0
    assert view.refresh().count() == 2
    n[0] = 5
    assert view.read().count() == 2 and view.refresh().count() == 5
    view.query = lambda: spark.range(3).unionAll(spark.range(1))
    with pytest.raises(ValueError):
        view.refresh()
    assert view.read().count() == 5  # a refresh that fails leaves the rows of the one before
    for name in ("t_results", "t_view"):
        spark.sql(f"DROP TABLE {name}")


def test_monthly_partitions(spark, tmp_path):
    rows = [(i, dt.datetime(2022, m, 3)) for i, m in enumerate((1, 1, 2, 7))]
    df = spark.createDataFrame(rows, "id int, payment_date timestamp_ntz")
    for part in (df, df.where("id < 2")):
        sinks.write_monthly(part, str(tmp_path / "p"))
    folders = sorted(p.name for p in (tmp_path / "p").iterdir() if p.is_dir())
    assert folders == ["payment_month=2022-01", "payment_month=2022-02", "payment_month=2022-07"]
    assert spark.read.parquet(str(tmp_path / "p")).count() == 4


def test_build_and_check_writes_only_on_pass(spark):
    spark.sql("DROP TABLE IF EXISTS t_checked")
    df = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    good = ("range", lambda d: checks.accepted_range(d, "x", 1, 2))
    bad = ("unique", lambda d: checks.unique(d, "x"))
    with pytest.raises(ValueError, match="unique"):
        staging.build_and_check(df, "t_checked", [bad, good])
    assert not spark.catalog.tableExists("t_checked")
    assert staging.build_and_check(df, "t_checked", [good]) == {"range": ("pass", 0)}
    assert spark.table("t_checked").count() == 3
    spark.sql("DROP TABLE t_checked")


def test_synthetic_events(spark):
    made = synthetic.synthetic_events(spark, "2024-01-02 00:00:00", 500)
    assert made.columns == ["id", "event_time", "user_id", "event_type", "value"]
    assert made.where("(event_type = 'purchase') <> (value is not null)").count() == 0
    assert made.where("event_time < '2024-01-01' or event_time > '2024-01-02'").count() == 0
    assert made.select("event_type").distinct().count() == 4
    assert sorted(made.repartition(7).collect()) == sorted(made.collect())


def test_words(spark):
    df = spark.createDataFrame([(1, "The Fate, of INDIA.", "x"), (2, "fateful india", "fate"), (3, None, None)], "id int, title string, body string")
    both = ("title", "body")
    ids = lambda c: [r["id"] for r in df.where(c).orderBy("id").collect()]
    assert ids(textsearch.has_word("title", "fate") & textsearch.has_word("title", "india")) == [1]
    assert ids(textsearch.has_word(both, "FATE")) == [1, 2]
    assert ids(textsearch.has_word(both, "india") & ~textsearch.has_word(both, "of")) == [2]
    assert sorted(df.select(textsearch.words("title")).first()[0]) == ["fate", "india", "of", "the"]
    with pytest.raises(ValueError):
        textsearch.has_word("title", "two words")


def test_source_to_model(spark):
    """Source, staging view, mart and model; the classes of this table are easy to tell apart."""
    source = spark.range(300).select(
        F.col("id").alias("key"), F.element_at(F.array(F.lit("setosa"), F.lit("versicolor"), F.lit("virginica")), (F.col("id") % 3 + 1).cast("int")).alias("class"),
        *[((F.col("id") % 3) * k + F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100)) / 120 + 1).alias(c) for k, c in enumerate(("a", "b", "c", "d"))],
    )
    staged = mart.staging_view(source, {"key": "key", "a": "a", "b": "b", "c": "c", "d": "d", "class": "species"})
    made = mart.feature_mart(staged, ["a", "b", "c", "d"], "species", ["key"], keep_key=True)
    columns, target = training.training_columns(made, "species", ["key"])
    assert target == "species_label_encoded" and len(columns) == 4 + 32 + 12
    metrics, importances = training.train_model(made, "species", ["key"], trees=10)
    scores = {r["model_type"]: r for r in metrics.collect()}
    assert scores["full_model"]["features_count"] == 48 and scores["top5_features_model"]["features_count"] == 5
    assert all(r["test_accuracy"] > 0.9 and r["train_accuracy"] > 0.9 for r in scores.values())
    assert importances.count() == 48 and abs(importances.agg(F.sum("importance")).first()[0] - 1) < 1e-6
    for name in ("t_metrics", "t_importance"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    training.save_results(metrics, importances, "2024-01-01", "t_metrics", "t_importance")
    training.save_results(metrics, importances, "2024-01-02", "t_metrics", "t_importance")
    assert spark.table("t_metrics").count() == 4 and spark.table("t_importance").count() == 96
    for name in ("t_metrics", "t_importance"):
        spark.sql(f"DROP TABLE {name}")


def test_wide_rows_are_written_once_and_models_scored_together(spark, monkeypatch):
    written, real = [], training.write_once
    monkeypatch.setattr(training, "write_once", lambda df: written.append(df) or real(df))
    rows = [(i, "ab"[i % 2], float(i % 2 * 3 + i % 5), None if i % 7 == 0 else float(i % 11)) for i in range(200)]
    made = spark.createDataFrame(rows, "k int, c string, x double, y double").withColumn("c_label_encoded", (F.col("c") == "b").cast("long"))
    prepared = training.prepare(made, ["x", "y"], "c_label_encoded", ["k"])
    # One form with all columns, NULLs as a feature of their own.
    assert prepared.names == ("x", "y", "y_is_missing") and [d.columns for d in written] == [["features", "label", "training"]]
    full = training.fit_forest(prepared, trees=5, depth=4)
    narrow = prepared.narrowed(["y_is_missing", "x"], full)
    assert len(written) == 2 and narrow.rows.first()["features"].size == 2
    for part, (n, share) in training.accuracies(narrow.rows, "hit").items():
        both = [tuple(r) for r in full.transform(prepared.rows).where(F.col("training") == part).select("prediction", "label").collect()]
        assert n == len(both) > 0 and share == sum(p == y for p, y in both) / n
    assert training.accuracies(narrow.rows.where("training"), "hit")[False][0] == 0
    at = {tuple(r) for r in made.select(F.col("y").isNull().cast("double"), "x").collect()}
    assert {tuple(r["features"].toArray().tolist()) for r in narrow.rows.collect()} == at


@pytest.mark.parametrize("failing", ["one", "two", "three"])
def test_a_run_goes_on_where_it_stopped(spark, tmp_path, failing):
    made, place = [], str(tmp_path)

    def step(name, after):
        def make(before):
            made.append(name)
            rows = before[after] if after else spark.range(5)
            if name == failing and made.count(name) == 1:
                rows = rows.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
            return rows.withColumn("id", F.col("id") + 1)

        return name, make

    steps = [step("one", None), step("two", "one"), step("three", "two")]
    with pytest.raises(Exception, match="lost"):
        run.run_steps(spark, place, "r1", steps)
    seen = versions.Versions(spark, place)
    assert seen.current() == {}
    for _ in range(2):
        done = run.run_steps(spark, place, "r1", steps)
    assert sorted(r.id for r in done["three"].collect()) == [3, 4, 5, 6, 7]
    assert {n: made.count(n) for n in ("one", "two", "three")} == {"one": 1, "two": 1, "three": 1} | {failing: 2}
    assert set(seen.current()) == {"one", "two", "three"} and seen.manifest().count() == 3
    # Another run makes all steps again; its tables take the place of the first run's together.
    run.run_steps(spark, place, "r2", steps, tables=["three"])
    assert seen.current()["three"] != seen.current("r1")["three"] and seen.current()["one"] == seen.current("r1")["one"]
    assert seen.sweep("three") == 1 and seen.read("three").count() == 5


def test_a_version_is_seen_when_it_is_published(spark, tmp_path):
    store = versions.Versions(spark, str(tmp_path))
    with pytest.raises(ValueError):
        store.read("a")
    first = {name: store.write(name, spark.range(n)) for name, n in (("a", 2), ("b", 3))}
    assert store.current() == {}
    store.publish(first, "r1")
    reader = store.read("a")
    store.write("a", spark.range(9))
    assert store.read("a").count() == 2 and store.read("b").count() == 3
    store.publish({"a": store.write("a", spark.range(4))}, "r2")
    assert store.read("a").count() == 4 and reader.count() == 2 and store.current("r1") == first
    with pytest.raises(ValueError):
        run.run_steps(spark, str(tmp_path / "x"), "r", [("a", lambda _: spark.range(1)), ("a", lambda _: spark.range(1))])


def test_tasks_read_no_more_than_a_bounded_share(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for given, want in (("128m", ("16777216b", "8388608b")), ("1GB", ("16777216b", "8388608b")), ("8m", ("8m", "8m")), ("4096", ("4096", "4096"))):
            for k in keys:
                spark.conf.set(k, given)
            session.tune(spark)
            assert tuple(spark.conf.get(k) for k in keys) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
