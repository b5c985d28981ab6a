"""URL filters by temporal list join.

A list is a log of dated entries (kind, key, listed_on, action add or remove). ``intervals`` turns it into
validity intervals, one array per key; ``judge`` looks every capture's keys up and counts the entries that
were active when it was fetched. Kinds: ``domain`` (the host and all its parent domains), ``prefix``
(host and leading path segments) and ``url`` (without scheme and fragment).

The log is reduced to one row per key and day before it is ordered, so a key costs at most one row a day
however often it is listed. Captures join the arrays, one row per key: a frequent host is split by the
skew handling of the join and no capture is multiplied by the length of a key's history.

Cases: a capture without url, without host or without fetch time matches nothing. Several entries of a key
on one day count as one; ``add`` wins. A remove without add does nothing, repeated adds go on. An interval
holds from its first day up to, and without, the day of the removal. Repeated captures are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.columns import shield


def host(url: str | Column) -> Column:
    """Lower-case host without user, port and trailing dot; empty if there is none."""
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?:[:/?#]|$)", 1)


def _path(url: str) -> Column:
    return F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)


def keys(url: str, of: Column) -> Column:
    """The keys under which a url may be listed: an array of (kind, key)."""
    labels = F.split(of, r"\.")
    n = F.size(labels)
    pair = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)),
                          lambda i: pair("domain", F.array_join(F.slice(labels, i, F.greatest(F.lit(1), n - i + 1)), ".")))
    segments = F.filter(F.split(F.regexp_replace(_path(url), r"\?.*$", ""), "/"), lambda s: s != "")
    prefixes = F.transform(segments, lambda s, i: pair("prefix", F.concat(of, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i + 1), "/"))))
    return F.when(of != "", F.array_distinct(F.concat(domains, prefixes, F.array(pair("url", F.concat(of, _path(url)))))))


def intervals(entries: DataFrame) -> DataFrame:
    """kind, key and ``active``, the array of (first, until) in which the key is listed; until may be null."""
    days = entries.filter("kind is not null and key is not null and listed_on is not null").groupBy("kind", "key", "listed_on").agg(
        F.max(F.when(F.col("action") == "add", 1).otherwise(0)).alias("added"))
    by_day = Window.partitionBy("kind", "key").orderBy("listed_on")
    # Only days on which the state changes begin or end an interval.
    changes = days.withColumn("before", F.lag("added").over(by_day)).filter(F.coalesce("before", F.lit(0)) != F.col("added"))
    changes = changes.withColumn("until", F.lead("listed_on").over(by_day)).filter("added = 1")
    return changes.groupBy("kind", "key").agg(F.sort_array(F.collect_list(F.struct(F.col("listed_on").alias("first"), "until"))).alias("active"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """All columns of ``captures`` (with url and fetched_on) and ``matches``, the sorted keys active at fetch time."""
    inner, restore = shield(captures, ["url", "fetched_on"])
    own = inner.columns
    rows = inner.withColumn("_host", host("url")).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumn("_keys", keys("url", F.col("_host")))
    looked = rows.select(*own, "_row", F.explode_outer("_keys").alias("_k")).select(
        *own, "_row", F.coalesce("_k.kind", F.lit("none")).alias("_kind"), F.coalesce("_k.key", F.col("_row").cast("string")).alias("_key"))
    listed = intervals(entries).select(F.col("kind").alias("_kind"), F.col("key").alias("_key"), F.col("active").alias("_active"))
    at = F.col("fetched_on")
    hit = F.exists("_active", lambda i: (i["first"] <= at) & (i["until"].isNull() | (at < i["until"])))
    joined = looked.join(listed, ["_kind", "_key"], "left").withColumn("_match", F.when(hit, F.concat_ws(":", "_kind", "_key")))
    found = joined.groupBy("_row").agg(*(F.first(c).alias(c) for c in own), F.sort_array(F.collect_set("_match")).alias("matches"))
    return restore(found.drop("_row"), "matches")
