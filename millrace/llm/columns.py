"""Columns that the caller brings along, and a key for rows that have none."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import write_once


def named(column: str) -> Column:
    """A column whose name may hold dots or spaces."""
    return F.col(f"`{column.replace('`', '``')}`")


def shield(df: DataFrame, used: Sequence[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with all columns but ``used`` renamed, so that they can't clash, and what gives them back.

    The second takes the operator's result and the names of its new columns. A new column takes the place
    of a column of the caller that has its name.
    """
    extra = {c: f"extra_{i}" for i, c in enumerate(df.columns) if c not in used}
    inner = df.select(*(named(c) for c in used), *(named(c).alias(n) for c, n in extra.items()))

    def restore(out: DataFrame, *new: str) -> DataFrame:
        own = [F.col(extra[c]).alias(c) if c in extra else named(c) for c in df.columns if c not in new and (c in extra or c in out.columns)]
        return out.select(*own, *new)

    return inner, restore


def release_shuffles(spark: SparkSession) -> None:
    """Delete the shuffle files of a query when it ends, not when the driver next collects its garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def keyed(df: DataFrame, key: str = "row_key") -> DataFrame:
    """``df`` with a key of each row: a hash of its file and its place there, the same in every scan.

    A frame that isn't read from files as it is, is written to the shared folder first.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(key)
    every = [named(c) for c in df.columns]
    try:
        return df.select(*every, place)
    except AnalysisException:
        return write_once(df).rows.select(*every, place)
