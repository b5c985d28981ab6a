"""Null-safe arithmetic on columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _or_zero(columns: Sequence[str | Column], caller: str) -> list[Column]:
    if isinstance(columns, (str, Column)) or len(columns) == 0:
        raise ValueError(f"{caller} takes a non-empty list of columns")
    return [F.coalesce(_column(c), F.lit(0)) for c in columns]


def safe_add(columns: Sequence[str | Column]) -> Column:
    """Sum of the columns, NULL counting as 0."""
    return reduce(lambda a, b: a + b, _or_zero(columns, "safe_add"))


def safe_subtract(columns: Sequence[str | Column]) -> Column:
    """First column minus all others, NULL counting as 0."""
    return reduce(lambda a, b: a - b, _or_zero(columns, "safe_subtract"))


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """NULL when the denominator is 0 or NULL; integers divide to a fraction."""
    return _column(numerator) / F.nullif(_column(denominator), F.lit(0))


def width_bucket(value: str | Column, low: float, high: float, buckets: int) -> Column:
    """Bucket 1..n of equal width on [low, high); 0 below and n + 1 from ``high`` on."""
    if buckets < 1 or not low < high:
        raise ValueError("width_bucket needs low < high and at least one bucket")
    return F.width_bucket(_column(value), F.lit(low), F.lit(high), F.lit(buckets))
