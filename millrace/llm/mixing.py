"""Mixing sources to target weights: balanced sampling by the cube method.

``targets`` shares a budget of words out to the sources by weight, no source above ``MOST`` times its own
words. A document of a source is taken ``target / size`` times in expectation: the whole part always, the
fraction by a draw that the cube method balances on documents and words of the source.

The flight moves the fractions of three documents at a time along the null space of the two balancing
constraints until one of them is 0 or 1. It runs in blocks of about ``BLOCK`` documents of one source, in
parallel; a block leaves at most two fractions, which meet in the blocks of the next level. Only in the last
block of a source, which leaves at most two documents, is the balance given up (landing); what that misses
is made up by exchanging documents of the block whose sizes differ by it.

Cases: a null or empty text, or one without words, has size 0 and is taken 0 times. Rows with a null source
form one source, the last. Rows with one id are handled one by one; draws depend on hashes of the rows and a
seed, so a rerun gives the same rows. If no text has a word all targets are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import release_shuffles, shield
from millrace.operators.ordering import row_numbers
from millrace.session import write_once

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK = 1000
#: Fractions that a block leaves: one for each balancing variable.
LEFT = 2
_EDGE = 1e-9


def words(text: str | Column = "text") -> Column:
    """Number of words parted by white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source``, ``n_rows`` (of a size above 0), ``source_size`` and ``target`` of each source.

    Sources stop at ``most`` times their size; what they would exceed is shared anew by weight among the
    rest. Each pass is one aggregation of the table of sources, and at least one source stops in it.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n_rows"))
    by = by.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_name", F.coalesce("source", F.lit("")))
    by = row_numbers(by, ["_null", "_name"], "_at")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("_at") % len(weights) + 1).cast("int"))
    by = write_once(by.select("source", "source_size", "n_rows", weight.alias("weight"))).rows
    budget = (by.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = 0.0, -1
    cap = most * F.col("source_size")
    while True:
        above = F.col("weight") * level >= cap
        row = by.agg(F.count(F.when(above, 1)).alias("n"), F.sum(F.when(above, cap)).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        if row is None or row.n == stopped or not row.open:
            break
        stopped, level = row.n, max(level, (budget - (row.full or 0.0)) / row.open)
    # With every source stopped (a budget of `most` times all words or above) all are at their caps.
    target = F.when(F.lit(bool(row is not None and not row.open)), cap).otherwise(F.least(cap, F.col("weight") * level))
    return by.select("source", "n_rows", "source_size", target.cast("double").alias("target"))


def flight(p: np.ndarray, x: np.ndarray, draws: np.random.Generator, landing: bool) -> np.ndarray:
    """Fractions after the flight phase; with ``landing`` all end at 0 or 1.

    Balances the sum of ``p`` and, until landing, the sum of ``p * x``.
    """
    p = p.astype(float).tolist()
    x = x.astype(float).tolist()
    order = [i for i in range(len(p)) if _EDGE < p[i] < 1 - _EDGE]
    hold: list[int] = []
    numbers = iter(draws.random(2 * len(order) + 8).tolist())
    at = 0
    while True:
        while len(hold) < 3 and at < len(order):
            hold.append(order[at])
            at += 1
        if len(hold) < 2 or (len(hold) < 3 and not landing):
            # Two documents of equal size are balanced as they are.
            if len(hold) == 2 and x[hold[0]] == x[hold[1]]:
                u = [1.0, -1.0]
            else:
                break
        elif len(hold) == 2:
            u = [1.0, -1.0]
        else:
            # Null vector of the rows (1, 1, 1) and (x, x, x).
            a, b, c = (x[i] for i in hold)
            u = [c - b, a - c, b - a]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        up = min(((1 - p[i]) / v if v > 0 else -p[i] / v) for i, v in zip(hold, u) if v)
        down = min((p[i] / v if v > 0 else (p[i] - 1) / v) for i, v in zip(hold, u) if v)
        move = up if next(numbers) * (up + down) < down else -down
        for i, v in zip(hold, u):
            p[i] = min(1.0, max(0.0, p[i] + move * v))
        hold = [i for i in hold if _EDGE < p[i] < 1 - _EDGE]
    if landing:
        for i in hold:
            p[i] = 1.0 if next(numbers) < p[i] else 0.0
    return np.array([0.0 if v <= _EDGE else 1.0 if v >= 1 - _EDGE else v for v in p])


def settle(before: np.ndarray, after: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exchanges a taken document for one that is not as long as that brings the words nearer to balance.

    Only documents whose fraction was open take part; the number of documents stays as it is.
    """
    after, free = after.copy(), (before > _EDGE) & (before < 1 - _EDGE)
    miss = float((after * x).sum() - (before * x).sum())
    while free.any():
        taken, left = np.flatnonzero(free & (after == 1)), np.flatnonzero(free & (after == 0))
        if not len(taken) or not len(left):
            break
        left = left[np.argsort(x[left], kind="stable")]
        # For each taken document the best partner is one of the two whose sizes surround x - miss.
        at = np.searchsorted(x[left], x[taken] - miss)
        best = min(((abs(miss - x[i] + x[left[k]]), i, left[k]) for i, j in zip(taken, at) for k in (j - 1, j) if 0 <= k < len(left)), key=lambda c: c[0])
        if best[0] >= abs(miss) - 1e-6:
            break
        after[best[1]], after[best[2]] = 0.0, 1.0
        miss += float(x[best[2]] - x[best[1]])
    return after


def mix(documents: DataFrame, seed: int = 42, block: int = BLOCK, **shares) -> DataFrame:
    """All columns of ``documents``, ``size``, ``source_size``, ``target`` and ``copies`` (times it is taken).

    ``documents`` has ``doc_id``, ``source`` and ``size``, or ``text`` to take the size from. Rows travel
    with their columns, so bring along only what is needed.
    """
    release_shuffles(documents.sparkSession)
    documents, restore = shield(documents, [c for c in ("doc_id", "source", "text", "size") if c in documents.columns])
    names = documents.columns
    rows = documents.withColumn("_size", F.col("size") if "size" in names else words())
    wanted = targets(rows.select("source", F.col("_size").alias("size")), **shares)
    wanted = wanted.select(F.col("source").alias("_s"), F.col("n_rows").alias("_rows"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    rows = rows.join(wanted, rows["source"].eqNullSafe(wanted["_s"])).drop("_s")
    ratio = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    rows = rows.withColumn("_copies", F.when(F.col("_size") > 0, F.floor(ratio)).otherwise(0).cast("long"))
    rows = rows.withColumn("_p", F.when(F.col("_size") > 0, ratio - F.floor(ratio)).otherwise(0.0))
    rows = rows.withColumn("_draw", F.xxhash64(F.lit(seed), "doc_id", "_size"))
    rows = rows.select(*names, "_size", "_source_size", "_target", "_copies", "_p", "_draw", "_rows")
    open_ = (F.col("_p") > _EDGE) & (F.col("_p") < 1 - _EDGE)
    schema, columns = rows.schema, rows.columns

    def fly(key: tuple, table: pa.Table) -> pa.Table:
        last = key[-1].as_py() == 1
        draw, size = table.column("_draw").to_numpy(), table.column("_size").to_numpy()
        ids = table.column("doc_id").fill_null(0).to_numpy() if pa.types.is_integer(table.column("doc_id").type) else draw
        order = np.lexsort((size, ids, draw))
        table = table.select(columns).take(pa.array(order))
        before = table.column("_p").to_numpy()
        p = flight(before, size[order], np.random.default_rng([seed, int(draw[order[0]]) & (2**63 - 1), len(order)]), last)
        if last:
            p = settle(before, p, size[order])
        return table.set_column(table.schema.get_field_index("_p"), "_p", pa.array(p))

    done, level, blocks = None, rows, None
    most = wanted.agg(F.max("_rows")).first()[0] or 0
    count = F.col("_rows")
    while True:
        blocks = F.greatest(F.lit(1), F.ceil(count / block)).cast("long")
        placed = level.withColumn("_block", F.pmod(F.xxhash64("_draw", F.lit(most)), blocks)).withColumn("_blocks", blocks)
        flown = placed.groupBy("source", "_block", "_blocks").applyInArrow(fly, schema)
        flown = write_once(flown).rows
        most = -(-most // block)
        done = flown.filter(~open_) if done is None else done.unionByName(flown.filter(~open_))
        if most <= 1:
            break
        # Each block has left two fractions at most.
        level, count, most = flown.filter(open_), LEFT * blocks, LEFT * most
    done = done.select(
        *(c for c in names if c != "size"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_copies") + F.round("_p").cast("long")).alias("copies"))
    return restore(done, "size", "source_size", "target", "copies")
