"""Joins whose small side is broadcast only when its size is known to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import quoted

BROADCAST_BYTES = 16 * 1024 * 1024
HOT_KEYS = 100
# Room for one broadcast row besides the text of its key.
ROW_BYTES = 64


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate: file sizes at the leaves, an upper estimate through filters."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the size estimate allows it; otherwise leave the choice to the optimizer."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def join_small(
    fact: DataFrame, dimension: DataFrame, on: str | Sequence[str] | Column, how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a dimension by broadcast if it is small enough, else by a shuffle that AQE may split."""
    return fact.join(small(dimension, max_bytes), on, how)


def lookup(
    df: DataFrame, mapping: DataFrame, key: str, count: str | None = None, max_bytes: int = 4 * BROADCAST_BYTES
) -> DataFrame:
    """Left null-safe join with a mapping that has one row per key and is already written or cached.

    The mapping is measured before it is broadcast. One that is too large is split by key frequency
    (``count`` names its frequency column): rows of the at most ``HOT_KEYS`` most frequent keys and of
    the NULL key are joined by broadcast, so no hot key travels through the shuffle; the rest is an
    ordinary shuffled join.
    """
    extra = [F.col(quoted(c)) for c in mapping.columns if c not in (key, count)]
    key, k = quoted(key), F.col(quoted(key))
    right = mapping.select(k.alias("_lookup_key"), *extra)
    same = k.eqNullSafe(F.col("_lookup_key"))
    width = F.coalesce(F.octet_length(k.cast("string")), F.lit(0)) + ROW_BYTES
    if (mapping.agg(F.sum(width)).first()[0] or 0) <= max_bytes:
        return df.join(F.broadcast(right), same, "left").drop("_lookup_key")
    order = [F.desc(count)] if count else []
    hot = [
        r[0] for r in
        mapping.where(k.isNotNull()).orderBy(*order, key).select(key).limit(HOT_KEYS).collect()
    ]
    is_hot = k.isNull() | k.isin(hot)
    hot_right = right.where(F.col("_lookup_key").isNull() | F.col("_lookup_key").isin(hot))
    hot_rows = df.where(is_hot).join(F.broadcast(hot_right), same, "left")
    cold_rows = df.where(~is_hot).join(right, k == F.col("_lookup_key"), "left")
    return hot_rows.unionByName(cold_rows).drop("_lookup_key")


def semi(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``; the keys are made distinct before the join."""
    columns = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*columns).distinct(), columns, "left_semi").select(*map(quoted, df.columns))


def anti(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``.

    Written as an anti join, since an outer join with a NULL filter is kept as an outer join; the keys
    are made distinct first, so a hot key is one row when it is shuffled.
    """
    columns = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*columns).distinct(), columns, "left_anti").select(*map(quoted, df.columns))
