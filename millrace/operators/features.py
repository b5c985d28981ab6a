"""Feature transforms with a fit and a transform step.

A feature names the facts it needs about the table (a minimum, a percentile, the categories of a column)
and makes its columns from them. ``fit`` gathers the facts of all features together: one aggregation
for every plain statistic and one distributed pass for all percentiles and quantile bins.
``Fitted.transform`` is then a projection, so no row is shuffled for scaling, binning or encoding, and
the same facts can be applied to new rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import slugify
from millrace.operators import ordering
from millrace.operators.aggregates import COMPARISONS, frequencies, most_frequent
from millrace.operators.joins import lookup
from millrace.session import write_once

ROW_KEY = "_row_key"
# Values of a column that the driver takes as a list, for one-hot columns and frequent values.
DRIVER_VALUES = 1000
# Up to this many codes are a CASE; more are looked up in a joined mapping.
CASE_VALUES = 20


@dataclass(frozen=True)
class Need:
    """One fact about the fitted table."""

    kind: str
    column: str
    detail: Any = None


Facts = Mapping[Need, Any]


@dataclass(frozen=True)
class Feature:
    """Columns made from a table, and the facts they need.

    ``make`` returns a column, or (suffix-complete name, column) pairs when one feature makes several.
    """

    make: Callable[[DataFrame, Facts], Column | list[tuple[str, Column]]]
    needs: tuple[Need, ...] = ()


_AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "stddev": F.stddev_samp,
    "max_abs": lambda c: F.max(F.abs(c)),
}


def _collect_categories(df: DataFrame, column: str, condition: Any) -> list | None:
    """Ordered distinct non-null values, or ``None`` when there are more than the driver takes."""
    rows = df.where(condition) if condition is not None else df
    found = (
        rows.where(F.col(column).isNotNull()).select(column).distinct()
        .orderBy(column).limit(DRIVER_VALUES + 1).collect()
    )
    return None if len(found) > DRIVER_VALUES else [r[0] for r in found]


def _gather(df: DataFrame, features: Mapping[str, Feature], key: Sequence[str]) -> dict[Need, Any]:
    needs = list(dict.fromkeys(n for f in features.values() for n in f.needs))
    facts: dict[Need, Any] = {}
    plain = [n for n in needs if n.kind in _AGGREGATES]
    if plain:
        row = df.agg(*[
            _AGGREGATES[n.kind](F.col(n.column).cast("double")).alias(f"s{i}") for i, n in enumerate(plain)
        ]).first()
        facts.update(zip(plain, row))
    shares: dict[str, list[float]] = {}
    tiles: dict[str, list[int]] = {}
    for n in needs:
        if n.kind == "percentile":
            shares.setdefault(n.column, []).append(n.detail)
        elif n.kind == "tiles":
            tiles.setdefault(n.column, []).append(n.detail)
    if shares or tiles:
        found, borders = ordering.column_ranks(df, shares, tiles, key)
        facts.update({Need("percentile", c, p): v for (c, p), v in found.items()})
        facts.update({Need("tiles", c, k): (rows, tuple(key)) for (c, k), rows in borders.items()})
    for n in needs:
        if n.kind == "mode":
            facts[n] = most_frequent(df, n.column)
        elif n.kind == "categories":
            facts[n] = _collect_categories(df, n.column, n.detail)
        elif n.kind == "frequent":
            # At most 1 / cutoff values can reach the cutoff, which bounds the list.
            kept = frequencies(df, n.column).where(F.col(n.column).isNotNull() & (F.col("share") >= n.detail))
            kept = kept.select(n.column, "n", F.lit(True).alias("_fact"))
            facts[n] = [r[0] for r in kept.collect()] if 1 / n.detail <= DRIVER_VALUES else write_once(kept).rows
        elif n.kind == "codes":
            known = facts.get(Need("categories", n.column)) or _collect_categories(df, n.column, None)
            if known is not None and len(known) <= CASE_VALUES:
                facts[n] = known
            else:
                facts[n] = ordering.dense_codes(df, n.column, "_fact")
    return facts


@dataclass(frozen=True)
class Fitted:
    """Features with the facts of the table they were fitted on."""

    features: Mapping[str, Feature]
    facts: Facts = field(default_factory=dict)

    def columns(self, df: DataFrame) -> list[Column]:
        made = []
        for name, feature in self.features.items():
            column = feature.make(df, self.facts)
            pairs = column if isinstance(column, list) else [(name, column)]
            made.extend(c.alias(n) for n, c in pairs)
        names = [n for n in df.select(*made).columns]
        twice = {n for n in names if names.count(n) > 1}
        if twice:
            raise ValueError(f"two features make the same column: {sorted(twice)}")
        return made

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """``df`` (or its ``keep`` columns) with the feature columns added."""
        kept = list(df.columns if keep is None else keep)
        for need, fact in self.facts.items():
            if isinstance(fact, DataFrame):
                df = lookup(df, fact.withColumnRenamed("_fact", _fact_column(need)), need.column, count="n")
        return df.select(*kept, *self.columns(df))


def fit(df: DataFrame, features: Mapping[str, Feature], key: Sequence[str] | None = None) -> Fitted:
    """Gather the facts of all features. ``key`` is a unique key; quantile bins split ties by it."""
    for feature in features.values():
        if not isinstance(feature, Feature):
            raise TypeError(f"not a feature: {feature!r}")
    if key is None and any(n.kind == "tiles" for f in features.values() for n in f.needs):
        raise ValueError("quantile bins need a unique key to split ties; fit_transform can supply one")
    return Fitted(dict(features), _gather(df, features, tuple(key or ())))


def fit_transform(
    df: DataFrame, features: Mapping[str, Feature], key: Sequence[str] | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """Fit on a table and transform it.

    Quantile bins split ties by ``key``. Without a key, or when a bin would begin between rows that the
    key does not tell apart, the rows are numbered and written once.
    """
    kept = list(df.columns if keep is None else keep)
    if key is not None or not any(n.kind == "tiles" for f in features.values() for n in f.needs):
        try:
            return fit(df, features, key).transform(df, kept)
        except ordering.DuplicateKey:
            pass
    numbered = write_once(df.withColumn(ROW_KEY, F.monotonically_increasing_id())).rows
    return fit(numbered, features, [*(key or ()), ROW_KEY]).transform(numbered, kept)


def _fact_column(need: Need) -> str:
    """Column that holds a fact too long for the driver once its mapping is joined."""
    return f"_{need.kind}_{need.detail}_of_{need.column}"


def _number(column: str) -> Column:
    return F.col(column).cast("double")


def _ratio(numerator: Column, denominator: float | None) -> Column:
    """NULL where the fitted column is constant or empty."""
    return numerator / F.nullif(F.lit(denominator).cast("double"), F.lit(0.0))


def bool_to_one_hot(columns: Sequence[str], null_as_one: bool = False, prefix: str = "is_") -> Feature:
    """1 for true, 0 for false, in ``<prefix><column>``; NULL becomes 0, or 1 on request."""
    def make(df: DataFrame, facts: Facts) -> list[tuple[str, Column]]:
        return [
            (prefix + c, F.coalesce(F.col(c), F.lit(null_as_one)).cast("int")) for c in columns
        ]

    return Feature(make)


def categorical_impute(column: str, measure: str = "mode") -> Feature:
    """NULL becomes the most frequent value."""
    if measure != "mode":
        raise ValueError(f"measure must be 'mode', not {measure!r}")
    need = Need("mode", column)
    return Feature(
        lambda df, facts: F.coalesce(F.col(column), F.lit(facts[need]).cast(df.schema[column].dataType)), (need,)
    )


def exponentiate(column: str, base: float | None = None) -> Feature:
    """``base`` to the power of the column; e without a base."""
    if base is None:
        return Feature(lambda df, facts: F.exp(_number(column)))
    return Feature(lambda df, facts: F.pow(F.lit(float(base)), _number(column)))


def interact(column_one: str, column_two: str, interaction: str = "multiplicative") -> Feature:
    ways = {
        "multiplicative": lambda a, b: a * b,
        "additive": lambda a, b: a + b,
        "exponential": F.pow,
    }
    if interaction not in ways:
        raise ValueError(f"interaction must be one of {sorted(ways)}, not {interaction!r}")
    return Feature(lambda df, facts: ways[interaction](F.col(column_one), F.col(column_two)))


def k_bins_discretize(column: str, k: int, strategy: str = "quantile") -> Feature:
    """Bin number 1..k: NTILE for ``quantile``, equal widths for ``uniform``.

    Uniform bins divide the range by k - 1, so only the maximum falls into bin k.
    """
    if strategy == "quantile":
        if k < 1:
            raise ValueError("quantile bins take 1 bin or more")
        need = Need("tiles", column, k)
        return Feature(lambda df, facts: ordering.ntile_column(df, column, *facts[need]), (need,))
    if strategy == "uniform":
        if k < 2:
            raise ValueError("uniform bins need k of at least 2")
        low, high = Need("min", column), Need("max", column)

        def make(df: DataFrame, facts: Facts) -> Column:
            if facts[low] is None:
                return F.lit(None).cast("long")
            width = (facts[high] - facts[low]) / float(k - 1)
            return (F.floor(_ratio(_number(column) - F.lit(facts[low]), width)) + 1).cast("long")

        return Feature(make, (low, high))
    raise ValueError(f"strategy must be 'quantile' or 'uniform', not {strategy!r}")


def label_encode(column: str) -> Feature:
    """Position of the value among the ordered distinct values, from 0; NULL gets the last code."""
    need = Need("codes", column)

    def make(df: DataFrame, facts: Facts) -> Column:
        if isinstance(facts[need], DataFrame):
            return F.col(f"`{_fact_column(need)}`").cast("long")
        values, x = facts[need], F.col(column)
        code = F.when(x.isNull(), len(values))
        for i, value in enumerate(values):
            code = code.when(x == F.lit(value), i)
        return code.cast("long")

    return Feature(make, (need,))


def log_transform(column: str, base: float = 10, offset: float = 0) -> Feature:
    """Logarithm of column + offset; NULL where that is not positive."""
    def make(df: DataFrame, facts: Facts) -> Column:
        x = _number(column) + F.lit(float(offset))
        return F.when(x > 0, F.log(float(base), x))

    return Feature(make)


def max_absolute_scale(column: str) -> Feature:
    need = Need("max_abs", column)
    return Feature(lambda df, facts: _ratio(_number(column), facts[need]), (need,))


def min_max_scale(column: str, new_min: float = 0, new_max: float = 1) -> Feature:
    low, high = Need("min", column), Need("max", column)

    def make(df: DataFrame, facts: Facts) -> Column:
        if facts[low] is None:
            return F.lit(None).cast("double")
        share = _ratio(_number(column) - F.lit(facts[low]), facts[high] - facts[low])
        return share * F.lit(float(new_max - new_min)) + F.lit(float(new_min))

    return Feature(make, (low, high))


def numerical_binarize(column: str, cutoff: float, strategy: str = "percentile", direction: str = ">=") -> Feature:
    """1 where the value compares to a cutoff given as a value or as a percentile, else 0; NULL gives 0."""
    if direction not in COMPARISONS:
        raise ValueError(f"direction must be one of {sorted(COMPARISONS)}, not {direction!r}")
    if strategy not in ("percentile", "value"):
        raise ValueError(f"strategy must be 'percentile' or 'value', not {strategy!r}")
    need = Need("percentile", column, float(cutoff))

    def make(df: DataFrame, facts: Facts) -> Column:
        border = facts[need] if strategy == "percentile" else float(cutoff)
        hit = COMPARISONS[direction](_number(column), F.lit(border).cast("double"))
        return F.when(hit, 1).otherwise(0)

    return Feature(make, (need,) if strategy == "percentile" else ())


def numerical_impute(column: str, measure: str = "mean", percentile: float = 0.5) -> Feature:
    """NULL becomes the mean, the median or a percentile of the column."""
    needs = {
        "mean": Need("avg", column),
        "median": Need("percentile", column, 0.5),
        "percentile": Need("percentile", column, float(percentile)),
    }
    if measure not in needs:
        raise ValueError(f"measure must be one of {sorted(needs)}, not {measure!r}")
    need = needs[measure]
    return Feature(lambda df, facts: F.coalesce(_number(column), F.lit(facts[need]).cast("double")), (need,))


def one_hot_encode(column: str, categories: Sequence[Any] | None = None, source_condition: str | None = None) -> Feature:
    """``is_<column>__<value>`` per non-null value, and ``is_<column>__`` for NULL.

    The values are the given ones, or those of the fitted table that meet the condition.
    """
    need = Need("categories", column, source_condition)

    def make(df: DataFrame, facts: Facts) -> list[tuple[str, Column]]:
        values = list(categories) if categories is not None else facts[need]
        if values is None:
            raise ValueError(f"{column} has more than {DRIVER_VALUES} values, too many for one column each")
        names = [f"is_{column}__{slugify(str(v))}" for v in values]
        if len(set(names)) < len(names):
            raise ValueError(f"values of {column} differ only in characters that names cannot hold: {values}")
        x = F.col(column)
        hot = [(n, F.when(x == F.lit(v), 1).otherwise(0)) for n, v in zip(names, values)]
        return [*hot, (f"is_{column}__", F.when(x.isNull(), 1).otherwise(0))]

    return Feature(make, () if categories is not None else (need,))


def one_hot_positions(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """One-hot encoding of a column of any number of values as the place of the 1, with the length of the vector.

    Adds ``is_<column>_at`` (from 0, in the order of the values, NULL last) and ``is_<column>_of``, the number of
    places: one for each value and one for NULL. These are the only entries of a sparse vector, so
    rows stay as wide as they are. Values are numbered without leaving the cluster and looked up by a join.
    """
    name = output or f"is_{column}"
    codes = write_once(ordering.dense_codes(df, column, f"{name}_at")).rows
    size = codes.agg((F.count(column) + 1).alias(f"{name}_of"))
    return lookup(df, codes, column, count="n").select(*df.columns, f"{name}_at").crossJoin(F.broadcast(size))


def poly_transform(column: str, degree: float) -> Feature:
    return Feature(lambda df, facts: F.pow(_number(column), F.lit(float(degree))))


def rare_category_encode(column: str, cutoff: float = 0.05) -> Feature:
    """Values whose share of all rows is below the cutoff become ``'Other'``; NULL stays NULL."""
    if not 0 <= cutoff <= 1:
        raise ValueError("the cutoff is a share between 0 and 1")
    if cutoff == 0:
        return Feature(lambda df, facts: F.col(column))
    need = Need("frequent", column, cutoff)

    def make(df: DataFrame, facts: Facts) -> Column:
        x, kept = F.col(column), facts[need]
        frequent = F.col(f"`{_fact_column(need)}`").isNotNull() if isinstance(kept, DataFrame) else x.isin(kept)
        return F.when(x.isNull(), F.lit(None)).when(frequent, x).otherwise(F.lit("Other"))

    return Feature(make, (need,))


def robust_scale(column: str, iqr: float = 0.5) -> Feature:
    """Distance from the median in units of the range that holds the middle ``iqr`` of the values."""
    if not 0 < iqr <= 1:
        raise ValueError("iqr is a share above 0 and at most 1")
    low, mid, high = (Need("percentile", column, p) for p in (0.5 - iqr / 2, 0.5, 0.5 + iqr / 2))

    def make(df: DataFrame, facts: Facts) -> Column:
        if facts[mid] is None:
            return F.lit(None).cast("double")
        return _ratio(_number(column) - F.lit(facts[mid]), facts[high] - facts[low])

    return Feature(make, (low, mid, high))


def standardize(column: str, target_mean: float = 0, target_stddev: float = 1) -> Feature:
    mean, spread = Need("avg", column), Need("stddev", column)

    def make(df: DataFrame, facts: Facts) -> Column:
        centred = _number(column) - F.lit(facts[mean]).cast("double")
        return _ratio(centred, facts[spread]) * F.lit(float(target_stddev)) + F.lit(float(target_mean))

    return Feature(make, (mean, spread))


def random_impute(
    df: DataFrame, column: str, key: Sequence[str] | None = None, seed: int = 42, consider_distribution: bool = True
) -> DataFrame:
    """NULLs of a column replaced by values drawn from the column.

    The draw inverts the distribution: distinct values in ascending order get intervals as long as their
    number of rows, or of length 1 if the distribution isn't to be considered, and a row with NULL takes the
    value in whose interval its number lies. The number is the first 15 hexadecimal digits of the md5 of the
    seed and the key, joined by ``|``, modulo the total length, so any engine can repeat it. Values are counted
    before they are ranged, so a hot value is one interval. Without values to draw from, NULL
    stays. Without a key, rows are numbered and written once.
    """
    columns = df.columns
    if key is None:
        df = write_once(df.withColumn(ROW_KEY, F.monotonically_increasing_id())).rows
        key = [ROW_KEY]
    filled, missing = df.where(F.col(column).isNotNull()), df.where(F.col(column).isNull())
    length = F.count(F.lit(1)) if consider_distribution else F.lit(1).cast("long")
    values = write_once(filled.groupBy(F.col(column).alias("_drawn")).agg(length.alias("_length"))).rows
    intervals = ordering.sums_before(values, ["_drawn"], "_length", "_start")
    total = values.agg(F.sum("_length").alias("_total"))
    number = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *key)), 1, 15), 16, 10).cast("long")
    kept = [F.col(c) for c in columns if c != column]
    points = missing.crossJoin(F.broadcast(total)).select(*kept, F.pmod(number, F.nullif("_total", F.lit(0))).alias("_draw"))
    drawn = ordering.interval_values(points, "_draw", intervals, "_start", "_drawn", column)
    return filled.select(*columns).unionAll(drawn.select(*columns))
