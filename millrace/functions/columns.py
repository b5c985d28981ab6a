"""Lists of columns of a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import slugify


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def get_filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names except a list, compared without case."""
    dropped = {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in dropped]


def star(
    df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "",
    relation_alias: str | None = None, quote_identifiers: bool = True,
) -> list[Column]:
    """All columns except a list, renamed only when a prefix or suffix is given."""
    scope = f"{quoted(relation_alias)}." if relation_alias else ""
    columns = []
    for name in get_filtered_columns(df, exclude):
        column = F.col(scope + quoted(name))
        if prefix or suffix:
            renamed = f"{prefix}{name}{suffix}"
            column = column.alias(renamed if quote_identifiers else slugify(renamed))
        columns.append(column)
    return columns


def nullcheck(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """The columns with empty text turned into NULL; other types unchanged."""
    wanted = list(df.columns if columns is None else columns)
    return [
        F.nullif(F.col(quoted(c)), F.lit("")).alias(c)
        if isinstance(df.schema[c].dataType, T.StringType) else F.col(quoted(c))
        for c in wanted
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))
