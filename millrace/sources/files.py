"""Tables from files, catalogs, databases and memory."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a sale record.
SALES_SCHEMA = "client string, purchase_date string, product string, price int"


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, **options: Any) -> DataFrame:
    """CSV with a header. A schema saves the extra pass that inference takes."""
    reader = spark.read.options(header=True, **options)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_columns(spark: SparkSession, path: str, schema: str | T.StructType, columns: Sequence[str]) -> DataFrame:
    """CSV with a header whose columns are taken in the listed order under the listed names."""
    table = read_csv(spark, path, schema, enforceSchema=True)
    if len(columns) != len(table.columns):
        raise ValueError(f"{len(columns)} names for {len(table.columns)} columns")
    return table.toDF(*columns)


def read_seed(
    spark: SparkSession, path: str, column_types: Mapping[str, str] | None = None, **options: Any
) -> DataFrame:
    """CSV with inferred types except those given by column; empty text loads as NULL."""
    inferred = read_csv(spark, path, **options)
    types = {k.lower(): v for k, v in (column_types or {}).items()}
    unknown = set(types) - {c.lower() for c in inferred.columns}
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    # Reading again with the final types keeps the text of overridden columns (leading zeros) intact.
    fields = [
        T.StructField(f.name, T.DataType.fromDDL(types[f.name.lower()]) if f.name.lower() in types else f.dataType)
        for f in inferred.schema
    ]
    return read_csv(spark, path, T.StructType(fields), **options)


def read_json_pages(
    spark: SparkSession, folder: str, schema: str | T.StructType = SALES_SCHEMA, pattern: str = "*.json"
) -> DataFrame:
    """Every page file of a folder, each one JSON array of records; a bad record is an error."""
    return spark.read.schema(schema).options(multiLine=True, mode="FAILFAST", pathGlobFilter=pattern).json(folder)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_query(spark: SparkSession, query: str, url: str | None = None, **options: Any) -> DataFrame:
    """Result of a query: of this session, or of a database when a JDBC address is given.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` with ``dbtable`` to
    read a large table in parallel.
    """
    if url is None:
        return spark.sql(query)
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    return (reader if "dbtable" in options else reader.option("query", query)).load()


def read_rows(
    spark: SparkSession, payload: str | Sequence[Mapping[str, Any]], schema: str | T.StructType | None = None
) -> DataFrame:
    """A list of records, or the same as JSON text, as a table."""
    rows = json.loads(payload) if isinstance(payload, str) else list(payload)
    if not rows and schema is None:
        raise ValueError("an empty list of records needs a schema")
    return spark.createDataFrame([dict(r) for r in rows], schema)


def describe_rows(df: DataFrame) -> dict[str, Any]:
    """Number of rows and the column names."""
    return {"rows": df.count(), "columns": df.columns}


def json_value(document: str | Column, path: str, data_type: str) -> Column:
    """Value at a path of a JSON text column; NULL when the path is absent."""
    column = F.col(document) if isinstance(document, str) else document
    return F.try_variant_get(F.try_parse_json(column), path, data_type)


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Column defaults applied at load: NULL becomes the default."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in defaults.items()
    })
