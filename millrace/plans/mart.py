"""The feature mart: every numeric column binned, scaled, binarized and combined, the class encoded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import features as ft


def mart_features(numeric: Sequence[str], label: str, bins: int = 5) -> dict[str, ft.Feature]:
    """Output column -> feature, for any numeric columns and one class column."""
    made: dict[str, ft.Feature] = {}
    for c in numeric:
        made[f"{c}_quantile_bin"] = ft.k_bins_discretize(c, bins, "quantile")
        made[f"{c}_uniform_bin"] = ft.k_bins_discretize(c, bins, "uniform")
    for c in numeric:
        made[f"{c}_robust_scaled"] = ft.robust_scale(c)
        made[f"{c}_max_absolute_scaled"] = ft.max_absolute_scale(c)
        made[f"{c}_max_min_max_scaled"] = ft.min_max_scale(c)
    made |= {f"{c}_logged": ft.log_transform(c, base=10) for c in numeric}
    made |= {f"{c}_binarized": ft.numerical_binarize(c, 0.5) for c in numeric}
    made |= {f"{c}_standardized": ft.standardize(c) for c in numeric}
    for a, b in combinations(numeric, 2):
        made[f"{a}_x_{b}_interaction"] = ft.interact(a, b)
        made[f"{a}_plus_{b}_interaction"] = ft.interact(a, b, "additive")
    made[f"{label}_label_encoded"] = ft.label_encode(label)
    made[f"is_{label}"] = ft.one_hot_encode(label)
    return made


def staging_view(source: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """The wanted columns of a source under their staging names."""
    return source.select(*[F.col(old).alias(new) for old, new in renames.items()])


def feature_mart(
    staged: DataFrame, numeric: Sequence[str], label: str, key: Sequence[str] | None = None, bins: int = 5,
    keep_key: bool = False,
) -> DataFrame:
    """The mart of a staged table. ``key`` is a unique key that splits ties between quantile bins."""
    kept = list(dict.fromkeys([*(key if key and keep_key else ()), *numeric, label]))
    return ft.fit_transform(staged, mart_features(numeric, label, bins), key, kept)
