"""Synthetic events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of events, and the ranges they are drawn from.
EVENT_TYPES = ("view", "click", "purchase", "signup")
WINDOW_SECONDS = 86_400
USERS = 1_000


def synthetic_events(
    spark: SparkSession, reference_time: datetime | str, rows: int = 100, seed: int = 42
) -> DataFrame:
    """Events of the day before ``reference_time``; only purchases carry a value.

    Every draw is a hash of the row number and the seed, so a lost task yields the same rows again.
    """
    draw = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(n))
    kind = F.element_at(F.array(*[F.lit(e) for e in EVENT_TYPES]), (draw(len(EVENT_TYPES), 1) + 1).cast("int"))
    moment = F.timestamp_add("SECOND", -draw(WINDOW_SECONDS + 1, 2), F.lit(reference_time).cast("timestamp_ntz"))
    value = (draw(10_001, 3) / 100).cast("decimal(5,2)")
    events = spark.range(1, rows + 1).select(
        F.col("id").cast("int").alias("id"), moment.alias("event_time"),
        (draw(USERS, 4) + 1).cast("int").alias("user_id"), kind.alias("event_type"), value.alias("drawn"),
    )
    return events.withColumn("value", F.when(F.col("event_type") == "purchase", F.col("drawn"))).drop("drawn")
