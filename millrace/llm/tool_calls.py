"""Tool calls linked to their results, ordered, validated and written as canonical JSON; built-in functions only.

Calls (conv_id, call_id, name, arguments as JSON text, after) and results (call_id, output) meet in a full hash
join on the identifier, both reduced to one row per identifier first. A call comes after the call whose
identifier ``after`` names; its level is the number of calls before it in that chain, found by pointer
doubling, so the rounds grow with the logarithm of the longest chain. Arguments are checked against
``schemas`` (name, field, type, required) and serialised with sorted keys and without white space.

Cases: rows that repeat an identifier are one call; the smallest arguments stay and ``n_rows`` counts them.
Calls without an identifier are left out. Arguments that aren't a JSON object, and null ones, are invalid and
have no canonical form. An unknown name is invalid. ``after`` that names no call makes a root, with
``dangling`` set. Calls in or behind a cycle have no level. Results whose identifier names no call are rows of
their own with ``n_rows`` 0, no level and the problem ``no_call``. Of differing outputs of one identifier, a null
one among them, the smallest that isn't null stays and ``n_outputs`` counts the different ones. Results without an
identifier are left out. Other columns of the tables are not read. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import write_once

#: Kinds of JSON values and how a variant's type begins.
TYPES = {
    "string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"],
    "object": ["OBJECT"], "array": ["ARRAY"], "null": ["VOID"],
}


def levels(calls: DataFrame) -> DataFrame:
    """call_id and level of calls (call_id, after); null in or behind a cycle."""
    nodes = calls.select("call_id", F.col("after").alias("up"))
    known = nodes.select(F.col("call_id").alias("up"))
    # A call that comes after no known call is a root.
    linked = nodes.join(known, "up", "left_semi").select("call_id", "up", F.lit(1).cast("long").alias("level"))
    roots = nodes.join(known, "up", "left_anti").select("call_id", F.lit(None).cast(calls.schema["call_id"].dataType).alias("up"), F.lit(0).cast("long").alias("level"))
    state = write_once(linked.unionByName(roots))
    n, open_ = state.rows.agg(F.count(F.lit(1)), F.count("up")).first()
    rounds = 0
    while open_ and 2**rounds <= n:
        done, moving = state.rows.filter("up is null"), state.rows.filter("up is not null")
        above = state.rows.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        moved = moving.join(above, "up").select("call_id", F.col("next").alias("up"), (F.col("level") + F.col("more")).alias("level"))
        after = write_once(done.unionByName(moved))
        state.delete()
        state, rounds = after, rounds + 1
        open_ = state.rows.filter("up is not null").count()
    return state.rows.select("call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def _has_type(kind: Column, value: Column) -> Column:
    is_ = F.schema_of_variant(value)
    out = F.lit(False)
    for name, starts in TYPES.items():
        one = F.lit(False)
        for start in starts:
            one = one | is_.startswith(start)
        out = F.when(kind == name, one).otherwise(out)
    return out


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per identifier: conv_id, call_id, name, level, n_rows, n_results, n_outputs, dangling, valid, problems, json."""
    calls = calls.filter("call_id is not null").groupBy("call_id").agg(
        F.min(F.struct("conv_id", "name", "arguments", "after")).alias("c"), F.count(F.lit(1)).alias("n_rows"))
    calls = calls.select("call_id", "c.*", "n_rows")
    calls = write_once(calls).rows
    results = results.filter("call_id is not null").groupBy("call_id", "output").agg(F.count(F.lit(1)).alias("n"))
    results = results.groupBy("call_id").agg(F.min("output").alias("output"), F.sum("n").alias("n_results"), F.count(F.lit(1)).alias("n_outputs"))
    shapes = schemas.groupBy("name").agg(F.collect_set(F.struct("field", "type", "required")).alias("fields")).withColumnRenamed("name", "_name")
    ids = calls.select(F.col("call_id").alias("after"), F.lit(True).alias("_there"))
    rows = (
        calls.join(levels(calls), "call_id").join(results, "call_id", "full")
        .join(ids, "after", "left").join(shapes, F.col("name") == F.col("_name"), "left")
    )
    value = F.try_parse_json("arguments")
    rows = rows.withColumn("_value", value).withColumn("_map", F.try_variant_get("_value", "$", "map<string,variant>"))
    missing = F.transform(F.filter("fields", lambda f: f["required"] & ~F.coalesce(F.map_contains_key("_map", f["field"]), F.lit(False))),
                          lambda f: F.concat(F.lit("missing:"), f["field"]))
    wrong = F.transform(F.filter("fields", lambda f: F.map_contains_key("_map", f["field"]) & ~_has_type(f["type"], F.element_at("_map", f["field"]))),
                        lambda f: F.concat(F.lit("type:"), f["field"]))
    unknown = F.transform(F.filter(F.map_keys("_map"), lambda k: ~F.exists("fields", lambda f: f["field"] == k)), lambda k: F.concat(F.lit("unknown:"), k))
    problems = (
        F.when(F.col("n_rows").isNull(), F.array(F.lit("no_call")))
        .when(F.col("_name").isNull(), F.array(F.lit("no_schema")))
        .when(F.col("_map").isNull(), F.array(F.lit("not_an_object")))
        .otherwise(F.sort_array(F.concat(missing, wrong, unknown)))
    )
    return rows.select(
        "conv_id", "call_id", "name", "level",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_rows", "n_results", "n_outputs")),
        (F.col("after").isNotNull() & F.col("_there").isNull()).alias("dangling"), problems.alias("problems"),
        F.when(F.col("_map").isNotNull(), F.to_json("_value")).alias("arguments"), "output",
    ).withColumn("valid", F.size("problems") == 0).withColumn("json", F.when(F.col("arguments").isNotNull(), F.to_json(F.try_parse_json(F.concat(
        F.lit('{"arguments":'), "arguments", F.lit(',"id":'), F.to_json(F.to_variant_object(F.array(F.col("call_id").cast("string")))),
        F.lit(',"name":'), F.to_json(F.to_variant_object(F.array("name"))), F.lit(',"result":'), F.to_json(F.to_variant_object(F.array("output"))), F.lit("}"))))))
