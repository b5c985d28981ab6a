"""Tables found by name in the session catalog."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.reshape import union_relations


def _like(pattern: str) -> re.Pattern:
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(c, re.escape(c)) for c in pattern), re.IGNORECASE | re.DOTALL)


def get_relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> dict[str, str]:
    """{qualified name: 'table' | 'view'} of tables whose schema and name match LIKE patterns, any case.

    Temporary views belong to no schema and match the schema pattern ``%`` only.
    """
    schema, table, excluded = _like(schema_pattern), _like(table_pattern), _like(exclude)
    found: dict[str, str] = {}
    catalog = spark.catalog
    databases = sorted(d.name for d in catalog.listDatabases() if schema.fullmatch(d.name))
    if not databases and schema.fullmatch(""):
        databases = [catalog.currentDatabase()]
    # The catalog compares what stands before the first wildcard, so that tables with other names aren't described.
    start = re.match(r"[A-Za-z0-9]*", table_pattern).group()
    for database in databases:
        for entry in catalog.listTables(database, f"{start}*"):
            owner = "" if entry.isTemporary else database
            if not schema.fullmatch(owner) or not table.fullmatch(entry.name) or (exclude and excluded.fullmatch(entry.name)):
                continue
            name = f"{owner}.{entry.name}" if owner else entry.name
            found[name] = "view" if entry.tableType in ("VIEW", "TEMPORARY") else "table"
    return dict(sorted(found.items()))


def get_relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> dict[str, str]:
    return get_relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def union_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "", **options) -> DataFrame:
    """Union of every table with the prefix."""
    names = get_relations_by_prefix(spark, schema, prefix, exclude)
    return union_relations({n.rsplit(".", 1)[-1]: spark.table(n) for n in names}, **options)


class Sources(Mapping):
    """Names bound to tables, views or paths: ``sources["analytics.iris"]`` is a DataFrame."""

    def __init__(self, spark: SparkSession, bindings: Mapping[str, str] | None = None):
        self._spark, self._bindings = spark, dict(bindings or {})

    def __getitem__(self, name: str) -> DataFrame:
        target = self._bindings.get(name, name)
        if "/" in target:
            return self._spark.read.load(target)
        if not self._spark.catalog.tableExists(target):
            raise KeyError(name)
        return self._spark.table(target)

    def __iter__(self):
        return iter(self._bindings)

    def __len__(self) -> int:
        return len(self._bindings)
