"""Connected components of a distributed graph by alternating star steps; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import write_once


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reached) of every node of ``edges`` (columns a, b; no direction).

    Each round links every node's larger neighbours, then its smaller ones, to the smallest; a round costs
    one aggregation and one join per step, and the rounds grow with the logarithm of the number of nodes.
    Nulls and loops are left out; repeated edges count once. Every round is written, so lineage stays short.
    """
    pairs = edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    state = write_once(pairs.distinct())
    seen = None
    while True:
        both = state.rows.select("u", "v").unionByName(state.rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        # The smallest neighbour stays the node's own; its other ones are linked to that.
        small = (
            large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
        )
        after = write_once(small)
        mark = after.rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        state.delete()
        state = after
        if mark == seen:
            return state.rows.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                state.rows.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = mark
