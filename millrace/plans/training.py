"""A random forest on the feature mart, its scores, and the five features that matter most."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from math import nan

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import write_once
from millrace.sinks.tables import append_results


def training_columns(mart: DataFrame, label: str, ignore: Sequence[str] = ()) -> tuple[list[str], str]:
    """Feature columns and the target: the encoded label stays, the label and its one-hot columns go."""
    target = f"{label}_label_encoded"
    dropped = {label, target, *ignore}
    return [c for c in mart.columns if c not in dropped and not c.startswith(f"is_{label}__")], target


def training_share(key: Sequence[str], seed: int = 42) -> Column:
    """A number from 0 to 1 for each row: the first 8 hexadecimal digits of the md5 of seed and key, joined by ``|``."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), *key)), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 32))


def split_rows(mart: DataFrame, key: Sequence[str] | None = None, share: float = 0.7, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, split by a hash of the key, or of the whole row without one.

    The split is the same in every run, retry and engine, however the rows are partitioned.
    """
    at = training_share(key or mart.columns, seed)
    return mart.where(at < share), mart.where(at >= share)


@dataclass(frozen=True)
class Prepared:
    """Rows written once as vectors: features, label, training; the names of the features by place in the vector."""

    rows: DataFrame
    names: tuple[str, ...]
    columns: tuple[str, ...]

    def narrowed(self, names: Sequence[str], model: RandomForestClassificationModel) -> Prepared:
        """The rows with the named features only, and whether ``model``, which reads all, was right (``hit``), written once.

        One scan of the wide vectors both scores a model and makes the rows of the next one.
        """
        scored = model.transform(self.rows).withColumnRenamed("features", "all")
        slicer = VectorSlicer(inputCol="all", outputCol="features", indices=[self.names.index(n) for n in names])
        rows = slicer.transform(scored).select("features", "label", "training", _hit())
        return Prepared(write_once(rows).rows, tuple(names), tuple(n for n in names if n in self.columns))


def prepare(mart: DataFrame, columns: Sequence[str], target: str, key: Sequence[str] | None = None, share: float = 0.7, seed: int = 42) -> Prepared:
    """Find the features with NULLs and write the mart's rows as vectors.

    A feature with NULLs counts as 0 where it is NULL and gets a feature of its own, ``<name>_is_missing``, so that a
    missing value and a value of 0 stay apart. The rows are written in one form only: writing fifty columns costs several
    times what it costs to project and aggregate them, so the mart is projected once more for the NULLs.
    """
    kept = mart.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(target).cast("double").alias("label"),
                       (training_share(key or mart.columns, seed) < share).alias("training"))
    gaps = kept.agg(*[F.max(F.col(c).isNull()).alias(c) for c in columns]).first()
    missing = [c for c in columns if gaps[c]]
    filled = kept.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in columns],
                         *[F.col(c).isNull().cast("double").alias(f"{c}_is_missing") for c in missing], "label", "training")
    names = (*columns, *(f"{c}_is_missing" for c in missing))
    rows = VectorAssembler(inputCols=list(names), outputCol="features").transform(filled).select("features", "label", "training")
    return Prepared(write_once(rows).rows, names, tuple(columns))


def fit_forest(prepared: Prepared, trees: int = 100, seed: int = 42, depth: int = 30) -> RandomForestClassificationModel:
    """A forest on the training rows, which predicts a class and leaves out the columns of its votes."""
    forest = RandomForestClassifier(numTrees=trees, seed=seed, maxDepth=depth, featuresCol="features", labelCol="label")
    return forest.fit(prepared.rows.where("training")).setRawPredictionCol("").setProbabilityCol("")


def _hit() -> Column:
    return (F.col("prediction") == F.col("label")).alias("hit")


def accuracies(rows: DataFrame, *hits: str) -> dict[bool, tuple]:
    """Of training (true) and test rows, counted in one scan: how many there are, and the share of each column that is true."""
    counted = rows.groupBy("training").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(h).alias(h) for h in hits]).collect()
    found = {r["training"]: (r["n"], *(r[h] / r["n"] for h in hits)) for r in counted}
    return {part: found.get(part, (0, *[nan] * len(hits))) for part in (True, False)}


def train_model(
    mart: DataFrame, label: str, key: Sequence[str] | None = None, trees: int = 100, seed: int = 42, top: int = 5,
    ignore: Sequence[str] | None = None, depth: int = 30,
) -> tuple[DataFrame, DataFrame]:
    """(metrics, importances) of a full model and of one refitted on its ``top`` features.

    ``ignore`` names columns that are no features; the key columns unless given. ``depth`` is the deepest that
    Spark's trees can be. Both models read vectors that were written once, each those of its own features, and
    are scored on all training and test rows.
    """
    columns, target = training_columns(mart, label, key or () if ignore is None else ignore)
    prepared = prepare(mart, columns, target, key, seed=seed)
    full = fit_forest(prepared, trees, seed, depth)
    importances = sorted(zip(prepared.names, full.featureImportances.toArray().tolist()), key=lambda r: (-r[1], r[0]))
    best = [name for name, _ in importances[:top]]
    narrow = prepared.narrowed(best, full)
    top_model = fit_forest(narrow, trees, seed, depth)
    scored = accuracies(top_model.transform(narrow.rows.withColumnRenamed("hit", "full_hit")).withColumn("top_hit", _hit()), "full_hit", "top_hit")
    (train_rows, train_score, train_top), (test_rows, test_score, test_top) = scored[True], scored[False]
    spark = mart.sparkSession
    metrics = spark.createDataFrame(
        [
            ("full_model", train_score, test_score, len(prepared.names), train_rows, test_rows),
            (f"top{top}_features_model", train_top, test_top, len(best), train_rows, test_rows),
        ],
        "model_type string, train_accuracy double, test_accuracy double, features_count int, train_rows long, test_rows long",
    )
    return metrics, spark.createDataFrame(importances, "feature string, importance double")


def save_results(
    metrics: DataFrame, importances: DataFrame, run_timestamp: datetime | str,
    metrics_table: str = "model_metrics", importance_table: str = "feature_importance",
    metrics_path: str | None = None, importance_path: str | None = None,
) -> None:
    """Append a run's results to their tables, whose files lie under the paths, or in the warehouse without them."""
    append_results(metrics, metrics_table, run_timestamp, metrics_path)
    append_results(importances, importance_table, run_timestamp, importance_path)
