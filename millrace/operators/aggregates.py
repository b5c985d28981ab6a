"""Aggregations: text concatenation, conditional columns, grouping by position, shares."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.names import slugify
from millrace.operators.ordering import row_numbers

# Spark keeps one string in one array, so a longer concatenation cannot be a column value.
LONGEST_TEXT = 2_000_000_000


def group_concat(
    df: DataFrame, by: Sequence[str], text: str, output: str, separator: str = ", ", distinct: bool = False
) -> DataFrame:
    """One text per group, NULLs skipped, values in ascending order; a group of NULLs gives NULL.

    Equal values are counted before the shuffle, so what reaches one task per group is its distinct
    values and their counts. The length of a group's text is added up over rows that may spill to disk, before any list
    is made; a text that would pass the limit of a cell raises an error there, it is never cut.
    ``group_concat_parts`` has no such limit.
    """
    counted = df.groupBy(*by, text).agg(F.count(F.lit(1)).alias("_times"))
    times = F.lit(1) if distinct else F.col("_times")
    width = F.when(F.col(text).isNotNull(), times * (F.octet_length(text) + len(separator)))
    too_long = F.raise_error(F.lit("group_concat: the text of a group does not fit in one value"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    checked = counted.withColumn("_width", F.sum(width).over(whole)).withColumn(
        "_value", F.when(F.col("_width") > LONGEST_TEXT, too_long.cast("string")).otherwise(F.col(text).cast("string")))
    # Equal texts are one entry with its number, which is written out only in the text itself.
    entry = F.struct(F.col(text).alias("t"), F.col("_value").alias("v"), times.cast("int").alias("n"))
    grouped = checked.groupBy(*by).agg(F.sort_array(F.collect_list(F.when(F.col("_value").isNotNull(), entry))).alias("_entries"))
    if distinct:
        parts = F.transform("_entries", lambda e: e["v"])
    else:
        parts = F.transform("_entries", lambda e: F.concat(F.repeat(F.concat(e["v"], F.lit(separator)), e["n"] - 1), e["v"]))
    return grouped.select(*by, F.when(F.size("_entries") > 0, F.array_join(parts, separator)).alias(output))


def group_concat_parts(
    df: DataFrame, by: Sequence[str], text: str, output: str, separator: str = ", ", part_rows: int = 10_000
) -> DataFrame:
    """The distinct texts of each group in ascending order as numbered parts of ``part_rows`` values.

    Joining the parts of a group by the separator gives its ``group_concat``; a group of any size is
    spread over as many tasks as it has parts.
    """
    values = df.where(F.col(text).isNotNull()).select(*by, text).distinct()
    numbered = row_numbers(values, [*by, text], "_place")
    # Positions run through the groups one after another, so a part is cut where either changes.
    parts = numbered.withColumn("part", F.floor(F.col("_place") / part_rows))
    grouped = parts.groupBy(*by, "part").agg(F.sort_array(F.collect_list(text)).alias("_texts"))
    return grouped.select(*by, "part", F.array_join("_texts", separator).alias(output))


COMPARISONS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def pivot(
    column: str | Column,
    values: Sequence[Any],
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Any = 1,
    else_value: Any = 0,
    quote_identifiers: bool = True,
    distinct: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One conditional aggregate per listed value, to be used in ``groupBy(...).agg(*pivot(...))``.

    A row that does not match contributes ``else_value``, so a missing combination is 0 and not NULL.
    ``then_value`` and ``else_value`` may be columns or constants.
    """
    if cmp not in COMPARISONS:
        raise ValueError(f"cmp must be one of {sorted(COMPARISONS)}")
    source = F.col(column) if isinstance(column, str) else column
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    columns = []
    for value in values:
        hit = F.when(COMPARISONS[cmp](source, F.lit(value)), as_column(then_value)).otherwise(as_column(else_value))
        if distinct:
            folded = {"count": F.count_distinct, "sum": F.sum_distinct}.get(agg, getattr(F, agg))(hit)
        else:
            folded = getattr(F, agg)(hit)
        name = f"{prefix}{value}{suffix}"
        columns.append(folded.alias(name if quote_identifiers else slugify(name)) if alias else folded)
    return columns


def pivot_long(df: DataFrame, by: Sequence[str], column: str, *aggregates: Column) -> DataFrame:
    """The cells of a pivot as rows (by, column, aggregates), for columns of more values than a table can have columns.

    Cells without rows are left out, as in a sparse matrix.
    """
    return df.groupBy(*by, column).agg(*aggregates)


def group_by_first(df: DataFrame, n: int):
    """Group by the first ``n`` columns of ``df``."""
    if not 0 <= n <= len(df.columns):
        raise ValueError(f"cannot group by {n} of {len(df.columns)} columns")
    return df.groupBy(*df.columns[:n])


def not_null_share(column: str) -> Column:
    return F.avg(F.col(column).isNotNull().cast("int"))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """(column, n, share) of every value, NULL included; shares are of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        column, "n", (F.col("n") / F.col("_total").cast("double")).alias("share")
    )


def most_frequent(df: DataFrame, column: str) -> Any:
    """The most frequent non-null value, the smallest one among ties; ``None`` when there is none."""
    top = (
        df.where(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column).limit(1).collect()
    )
    return top[0][0] if top else None
