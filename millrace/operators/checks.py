"""Data-quality checks.

A check takes a table and returns its failing rows as a lazy DataFrame; it passes when there are none.
Only one number leaves the cluster, in ``evaluate``. Checks that compare a row with its neighbour count
equal rows first and report how many rows each failing line stands for in ``n_rows``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import get_filtered_columns, quoted
from millrace.functions.dates import dateadd
from millrace.functions.names import slugify
from millrace.operators.aggregates import not_null_share
from millrace.operators.joins import anti
from millrace.operators.ordering import neighbour
from millrace.operators.reshape import symmetric_difference

# How failing rows are turned into one number, where it is not their count.
FAIL_CALC = {
    "equality": "count(*) + coalesce(abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a')), 0)",
    "equal_rowcount": "sum(coalesce(diff_count, 0))",
    "fewer_rows_than": "sum(coalesce(row_count_delta, 0))",
    "sequential_values": "sum(n_rows)",
    "mutually_exclusive_ranges": "sum(n_rows)",
}


def evaluate(
    failures: DataFrame, fail_calc: str = "count(*)", error_if: str = "!= 0", warn_if: str = "!= 0"
) -> tuple[str, int]:
    """('pass' | 'warn' | 'error', number of failures); no failing row reaches the driver."""
    n = F.coalesce(F.expr(fail_calc), F.lit(0)).alias("n")
    row = failures.agg(n).select("n", F.expr(f"n {error_if}"), F.expr(f"n {warn_if}")).first()
    return ("error" if row[1] else "warn" if row[2] else "pass"), row[0]


def run_check(
    check: Callable[..., DataFrame], df: DataFrame, *args: Any, where: str | Column | None = None,
    error_if: str = "!= 0", warn_if: str = "!= 0", **options: Any,
) -> tuple[str, int]:
    """Apply a check to the rows that meet ``where`` and evaluate it with its own failure count."""
    rows = df.where(where) if where is not None else df
    return evaluate(check(rows, *args, **options), FAIL_CALC.get(check.__name__, "count(*)"), error_if, warn_if)


def _value(expression: str | Column) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


@dataclass(frozen=True)
class Rule:
    """A check as an expression: true for the rows that fail it, of those that meet ``where``.

    With ``by`` the expression is over aggregates and true for the failing groups of these columns.
    """

    failing: Column
    where: str | Column | None = None
    by: tuple[str, ...] = ()
    error_if: str = "!= 0"
    warn_if: str = "!= 0"

    def __post_init__(self):
        if self.by and self.where is not None:
            raise ValueError("filter a table before its groups are checked")


def check_together(df: DataFrame, rules: Mapping[str, Rule]) -> dict[str, tuple[str, int]]:
    """{name: ('pass' | 'warn' | 'error', number of failing rows or groups)} of many checks of one table.

    All rules on rows are one conditional aggregate, so the table is scanned once whatever their number. Rules on
    groups of the same columns share one more scan and its shuffle. One row for each of these reaches the driver.
    """
    counts: dict[str, int] = {}
    shares: dict[tuple[str, ...], list[str]] = {}
    for name, rule in rules.items():
        shares.setdefault(tuple(sorted(rule.by)), []).append(name)
    for by, names in shares.items():
        failing = {name: F.coalesce(rules[name].failing, F.lit(False)) for name in names}
        if by:
            flags = [failing[name].alias(f"f{i}") for i, name in enumerate(names)]
            groups = df.groupBy(*[F.col(quoted(c)) for c in by]).agg(*flags)
            row = groups.agg(*[F.count_if(f"f{i}") for i in range(len(names))]).first()
        else:
            met = lambda name: F.lit(True) if rules[name].where is None else F.coalesce(_value(rules[name].where), F.lit(False))
            row = df.agg(*[F.count_if(met(name) & failing[name]) for name in names]).first()
        counts |= dict(zip(names, row))
    texts = [F.expr(f"{counts[name]} {rule}") for name, r in rules.items() for rule in (r.error_if, r.warn_if)]
    status = df.sparkSession.range(1).select(*texts).first() if texts else ()
    return {name: ("error" if status[2 * i] else "warn" if status[2 * i + 1] else "pass", counts[name]) for i, name in enumerate(rules)}


def not_null_rule(column: str, **options: Any) -> Rule:
    return Rule(F.col(column).isNull(), **options)


def true_rule(expression: str | Column, **options: Any) -> Rule:
    """Rows where the expression is false; NULL passes."""
    return Rule(~_value(expression), **options)


def range_rule(column: str, min_value: Any = None, max_value: Any = None, inclusive: bool = True, **options: Any) -> Rule:
    return Rule(_outside(column, min_value, max_value, inclusive), **options)


def unique_rule(columns: Sequence[str], nulls: bool = False, **options: Any) -> Rule:
    """Keys that occur more than once; keys with a NULL pass unless NULLs are to be values."""
    known = F.lit(True) if nulls else reduce(lambda a, b: a & b, [F.first(F.col(c)).isNotNull() for c in columns])
    return Rule(known & (F.count(F.lit(1)) > 1), by=tuple(columns), **options)


def values_rule(column: str, values: Sequence[Any], **options: Any) -> Rule:
    """Distinct values outside the list; NULL passes."""
    return Rule(~F.first(F.col(column)).isin(*values), by=(column,), **options)


def accepted_range(
    df: DataFrame, column: str, min_value: Any = None, max_value: Any = None, inclusive: bool = True
) -> DataFrame:
    """Rows outside the bounds; NULL passes. A bound may be a constant or a column, and either may be left out."""
    return df.where(_outside(column, min_value, max_value, inclusive))


def _outside(column: str, min_value: Any, max_value: Any, inclusive: bool) -> Column:
    x, outside = F.col(column), F.lit(False)
    bound = lambda v: v if isinstance(v, Column) else F.lit(v)
    if min_value is not None:
        outside = outside | (x < bound(min_value) if inclusive else x <= bound(min_value))
    if max_value is not None:
        outside = outside | (x > bound(max_value) if inclusive else x >= bound(max_value))
    return outside


def at_least_one(df: DataFrame, column: str, group_by_columns: Sequence[str] = ()) -> DataFrame:
    """One row when the column holds no value at all, or one row per group without a value."""
    if group_by_columns:
        filled = df.groupBy(*group_by_columns).agg(F.count(column).alias("n_values"))
    else:
        filled = df.where(F.col(column).isNotNull()).select(column).limit(1).agg(F.count(column).alias("n_values"))
    return filled.where(F.col("n_values") == 0)


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """(value, number of rows) pairs that only one of the two columns has."""
    count = lambda table, c: table.groupBy(F.col(c).alias(column)).agg(F.count(F.lit(1)).alias("num_rows"))
    return symmetric_difference(count(df, column), count(to, field)).drop("which_diff")


def _count_both(a: DataFrame, b: DataFrame, by: Sequence[str], name_a: str, name_b: str) -> DataFrame:
    """Row counts of two tables per group; NULL groups match and a missing side counts 0.

    Each table is counted first, so what is shuffled and matched is one row per group and task.
    """
    zero = F.lit(0).cast("long")
    count = F.count(F.lit(1))
    ours = a.groupBy(*by).agg(count.alias(name_a)).withColumn(name_b, zero)
    theirs = b.groupBy(*by).agg(count.alias(name_b)).withColumn(name_a, zero)
    return ours.unionByName(theirs).groupBy(*by).agg(F.sum(name_a).alias(name_a), F.sum(name_b).alias(name_b))


def equal_rowcount(df: DataFrame, compare_model: DataFrame, group_by_columns: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) whose row counts differ."""
    counts = _count_both(df, compare_model, group_by_columns, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b"))).where("diff_count <> 0")


def fewer_rows_than(df: DataFrame, compare_model: DataFrame, group_by_columns: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) without strictly fewer rows than the other table."""
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    counts = _count_both(df, compare_model, group_by_columns, "count_our_model", "count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0).cast("long")
    return counts.withColumn("row_count_delta", delta).where("row_count_delta <> 0")


def equality(
    df: DataFrame, compare_model: DataFrame, compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None, precision: int | None = None, keep_duplicates: bool = False,
) -> DataFrame:
    """Rows of one table that the other lacks, on all, the chosen, or the remaining columns.

    ``precision`` rounds numbers first. Rows are compared as sets unless ``keep_duplicates``.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give either compare_columns or exclude_columns, not both")
    if compare_columns:
        columns = list(compare_columns)
    else:
        columns = get_filtered_columns(df, exclude_columns or ())
        others = get_filtered_columns(compare_model, exclude_columns or ())
        if {c.lower() for c in columns} != {c.lower() for c in others}:
            raise ValueError("the tables have different columns; use compare_columns or exclude_columns")

    def comparable(table: DataFrame) -> DataFrame:
        types = {f.name.lower(): f.dataType for f in table.schema}
        rounded = lambda c: precision is not None and isinstance(types[c.lower()], T.FractionalType)
        return table.select(*[
            (F.round(quoted(c), precision) if rounded(c) else F.col(quoted(c))).alias(c) for c in columns
        ])

    return symmetric_difference(comparable(df), comparable(compare_model), keep_duplicates)


def expression_is_true(df: DataFrame, expression: str | Column, column_name: str | None = None) -> DataFrame:
    """Rows where the expression is false; NULL passes. With a column the expression follows its name."""
    if column_name and isinstance(expression, str):
        expression = f"{quoted(column_name)} {expression}"
    return df.where(~_value(expression))


_GAP_RULES = {
    "not_allowed": ("equal_to", lambda upper, following: upper == following),
    "allowed": ("less_than_or_equal_to", lambda upper, following: upper <= following),
    "required": ("less_than", lambda upper, following: upper < following),
}


def mutually_exclusive_ranges(
    df: DataFrame, lower_bound_column: str | Column, upper_bound_column: str | Column,
    partition_by: str | None = None, gaps: str = "allowed", zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty, reversed, or meet the next range of their partition against the gap rule.

    NULL bounds fail and sort last; the last range of a partition has no next one to meet.
    """
    if gaps not in _GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(_GAP_RULES)}, not {gaps!r}")
    words, meets = _GAP_RULES[gaps]
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    lower, upper = F.col("lower_bound"), F.col("upper_bound")
    group = ["partition_by_col"] if partition_by else []
    keys = [F.expr(partition_by).alias("partition_by_col")] if partition_by else []
    ranges = df.select(
        *keys, _value(lower_bound_column).alias("lower_bound"), _value(upper_bound_column).alias("upper_bound")
    )
    counted = (
        ranges.groupBy(*ranges.columns).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_lower_null", lower.isNull()).withColumn("_upper_null", upper.isNull())
    )
    order = ["_lower_null", "lower_bound", "_upper_null", "upper_bound"]
    following = neighbour(counted, group, order, "lower_bound", "next_lower", ahead=True)
    # Of n equal ranges all but the last are followed by a copy of themselves.
    copies = F.struct((F.col("n") - 1).alias("n_rows"), lower.alias("next_lower_bound"), F.lit(False).alias("is_last_record"))
    last = F.struct(
        F.lit(1).cast("long").alias("n_rows"), F.col("next_lower").alias("next_lower_bound"),
        (~F.col("next_lower_exists")).alias("is_last_record"),
    )
    long_enough = lower <= upper if zero_length_range_allowed else lower < upper
    ok_length, ok_next = f"lower_bound_{length_words}_upper_bound", f"upper_bound_{words}_next_lower_bound"
    return (
        following.select(*ranges.columns, F.explode(F.array(copies, last)).alias("r"))
        .where("r.n_rows > 0")
        .select(*ranges.columns, "r.next_lower_bound", "r.is_last_record", "r.n_rows")
        .withColumn(ok_length, F.coalesce(long_enough, F.lit(False)))
        .withColumn(ok_next, F.coalesce(meets(upper, F.col("next_lower_bound")), F.col("is_last_record"), F.lit(False)))
        .where(~(F.col(ok_length) & F.col(ok_next)))
    )


def not_accepted_values(df: DataFrame, column: str, values: Sequence[Any], quote: bool = True) -> DataFrame:
    """Distinct values of the column that are on the forbidden list.

    ``quote=False`` takes the list as SQL expressions instead of constants.
    """
    forbidden = [F.lit(v) for v in values] if quote else [F.expr(str(v)) for v in values]
    return df.select(F.col(column).alias("value_field")).distinct().where(F.col("value_field").isin(*forbidden))


def not_constant(df: DataFrame, column: str, group_by_columns: Sequence[str] = ()) -> DataFrame:
    """One row when the column has exactly one distinct value (per group).

    Minimum and maximum decide that without keeping the values apart.
    """
    grouped = df.groupBy(*group_by_columns).agg(
        (F.min(column).eqNullSafe(F.max(column)) & (F.count(column) > 0)).alias("_constant")
    )
    return grouped.where("_constant").select(*group_by_columns, F.lit(1).cast("long").alias("n_distinct"))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    text = F.col(column)
    return df.where((F.trim(text) if trim_whitespace else text) == "")


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by_columns: Sequence[str] = ()
) -> DataFrame:
    """Groups (or the table) whose share of non-null values is out of bounds."""
    share = F.col("not_null_proportion")
    return (
        df.groupBy(*group_by_columns).agg(not_null_share(column).alias("not_null_proportion"))
        .where((share < at_least) | (share > at_most))
    )


def recency(
    df: DataFrame, field: str, datepart: str, interval: int, reference_time: datetime | str,
    ignore_time_component: bool = False, group_by_columns: Sequence[str] = (), fail_if_empty: bool = False,
) -> DataFrame:
    """Groups (or the table) whose newest moment lies before ``reference_time`` minus the interval."""
    kind = "date" if ignore_time_component else df.schema[field].dataType
    threshold = dateadd(datepart, -interval, F.lit(reference_time).cast("timestamp_ntz")).cast(kind)
    newest = df.groupBy(*group_by_columns).agg(F.max(field).cast(kind).alias("most_recent"))
    stale = F.col("most_recent") < F.col("threshold")
    if fail_if_empty:
        stale = stale | F.col("most_recent").isNull()
    return newest.withColumn("threshold", threshold).where(stale)


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str,
    from_condition: str | Column = "1=1", to_condition: str | Column = "1=1",
) -> DataFrame:
    """Child ids without a parent, one row per child row."""
    children = df.where(F.col(column).isNotNull()).where(from_condition).select(F.col(column).alias("id"))
    parents = to.where(F.col(field).isNotNull()).where(to_condition).select(F.col(field).alias("id"))
    return anti(children, parents, "id")


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once, with their number of rows; NULLs are one value."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
    group_by_columns: Sequence[str] = (),
) -> DataFrame:
    """Values that are not the previous value of their group plus the interval; the first one passes."""
    previous = f"previous_{slugify(column)}"
    x, before = F.col(column), F.col("r.before")
    counted = (
        df.where(x.isNotNull()).groupBy(*group_by_columns, column).agg(F.count(F.lit(1)).alias("n"))
    )
    following = neighbour(counted, group_by_columns, [column], column, "before")
    # Of n equal values all but the first follow a copy of themselves.
    first = F.struct(F.lit(1).cast("long").alias("n_rows"), F.col("before").alias("before"))
    copies = F.struct((F.col("n") - 1).alias("n_rows"), x.alias("before"))
    step = dateadd(datepart, interval, before).cast(df.schema[column].dataType) if datepart else before + F.lit(interval)
    return (
        following.select(*group_by_columns, column, F.explode(F.array(first, copies)).alias("r"))
        .where(F.col("r.n_rows") > 0).where(x != step)
        .select(*group_by_columns, column, before.alias(previous), "r.n_rows")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return unique_combination_of_columns(df.where(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Distinct values outside the list with their number of rows; NULL passes."""
    return (
        df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
        .where(~F.col("value_field").isin(*values))
    )


def columns_match_set(spark: SparkSession, df: DataFrame, expected: Sequence[str], case_folded: bool = True) -> DataFrame:
    """Column names that only the table or only the list has."""
    fold = str.upper if case_folded else str
    have, want = {fold(c) for c in df.columns}, {fold(c) for c in expected}
    rows = [(c, "table" if c in have else "list") for c in sorted(have ^ want)]
    return spark.createDataFrame(rows, "column_name string, found_in string")


def assert_equal(df: DataFrame, actual: str | Column, expected: str | Column, tolerance: float | None = None) -> DataFrame:
    """Rows where two columns differ, NULL being equal only to NULL; ``tolerance`` is for numbers."""
    a, b = _value(actual), _value(expected)
    if tolerance is None:
        return df.where(~a.eqNullSafe(b))
    return df.where((a.isNull() != b.isNull()) | (F.abs(a - b) > tolerance))


def assert_equal_string(df: DataFrame, actual: str | Column, expected: str | Column) -> DataFrame:
    return assert_equal(df, _value(actual).cast("string"), _value(expected).cast("string"))


def assert_close(df: DataFrame, actual: str | Column, expected: str | Column, decimals: int = 2) -> DataFrame:
    return assert_equal(df, F.round(_value(actual), decimals), F.round(_value(expected), decimals))


def assert_not_null(df: DataFrame, actual: str | Column) -> DataFrame:
    return df.where(_value(actual).isNull())
