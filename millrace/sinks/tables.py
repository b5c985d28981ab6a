"""Tables, views and partitioned folders written by Spark."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import write_once


def replace_folder(df: DataFrame, path: str, format: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace a folder; with partition columns only the partitions present in ``df`` are replaced.

    Writing the same rows again leaves the same content, so a run may be repeated.
    """
    if partition_by:
        # Small partitions get one file, and large ones as many tasks as their size asks for.
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    writer = df.write.format(format).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def save_table(df: DataFrame, name: str, format: str = "parquet", path: str | None = None) -> DataFrame:
    """Materialize a model as a table; its files lie under ``path``, or in the warehouse without one."""
    writer = df.write.format(format).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Materialize a model as a view of the session."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


class MaterializedView:
    """A table that holds the result of a query as of its last refresh; created empty."""

    def __init__(
        self, spark: SparkSession, name: str, query: Callable[[], DataFrame], key: Sequence[str] = (), path: str | None = None
    ):
        self.spark, self.name, self.query, self.key, self.path = spark, name, query, tuple(key), path

    def create(self) -> None:
        create_if_absent(self.spark, self.name, self.query().schema, path=self.path)

    def refresh(self) -> DataFrame:
        """Recompute beside the table, verify that the key is unique, and only then replace the table."""
        written = write_once(self.query())
        try:
            if self.key:
                repeated = written.rows.groupBy(*self.key).count().where(F.col("count") > 1)
                if not repeated.isEmpty():
                    raise ValueError(f"{self.name}: key {', '.join(self.key)} is not unique")
            return save_table(written.rows, self.name, path=self.path)
        finally:
            written.delete()

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


def create_if_absent(
    spark: SparkSession, name: str, schema: str | T.StructType, format: str = "parquet", path: str | None = None
) -> None:
    columns = schema.toDDL() if isinstance(schema, T.StructType) else schema
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {format}{location}")


def append_results(df: DataFrame, name: str, run_timestamp: datetime | str, path: str | None = None) -> None:
    """Append rows stamped with the run's time; the table is created when absent."""
    stamped = df.withColumn("run_timestamp", F.lit(run_timestamp).cast("timestamp"))
    create_if_absent(df.sparkSession, name, stamped.schema, path=path)
    columns = df.sparkSession.table(name).columns
    stamped.select(*columns).write.mode("append").insertInto(name)


def with_month(df: DataFrame, moment: str = "payment_date", output: str = "payment_month") -> DataFrame:
    return df.withColumn(output, F.date_format(moment, "yyyy-MM"))


def write_monthly(df: DataFrame, path: str, moment: str = "payment_date", output: str = "payment_month") -> None:
    """Write with one partition per month; a month not seen before becomes a new partition."""
    replace_folder(with_month(df, moment, output), path, partition_by=[output])


def stamp_last_update(df: DataFrame, run_timestamp: datetime | str, column: str = "last_update") -> DataFrame:
    """Mark every row as written by this run."""
    return df.withColumn(column, F.lit(run_timestamp).cast("timestamp"))
