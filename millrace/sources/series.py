"""Series of numbers and dates."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import check_part, dateadd, datediff


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..n as ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError(f"a series needs at least one number, not {upper_bound}")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def date_spine(
    spark: SparkSession, datepart: str, start_date: date | datetime | str, end_date: date | datetime | str
) -> DataFrame:
    """One row per date part from start on, the end excluded, in the column ``date_<datepart>``.

    There are as many rows as part boundaries between start and end. Each row is start + i parts of its
    own, so month steps from the 31st do not drift, and the spine is generated in parallel at any length.
    """
    part = check_part(datepart)
    start, end = (F.lit(d).cast("timestamp_ntz") for d in (start_date, end_date))
    boundaries = spark.range(1).select(datediff(part, start, end)).first()[0]
    moment = dateadd(part, (F.col("generated_number") - 1).cast("int"), start)
    name = f"date_{part}"
    return generate_series(spark, boundaries).select(moment.alias(name)).where(F.col(name) <= end)


def generate_numbers(spark: SparkSession, n: int) -> DataFrame:
    """The column ``number`` holding 1..n."""
    return spark.range(1, n + 1).withColumnRenamed("id", "number")


def multiply(numbers: DataFrame, factor: float, column: str = "number") -> DataFrame:
    return numbers.withColumn(column, F.col(column) * F.lit(factor))
