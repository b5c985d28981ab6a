"""Global order without a one-task sort.

Whole-table windows (``ntile() over (order by x)``, ``dense_rank()``, an ungrouped ``lag``) put every
row into a single task. The functions here range-partition instead. Partition numbers must not change
between the pass that counts and the pass that uses them, so the ranged rows are written once to the
shared folder (``write_once``) and everything after reads what was written.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from math import ceil, floor, isnan

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import Written, write_once

_PID, _POS, _N = "_range_pid", "_range_pos", "_range_n"
# Blocks of partitions that one task of a prefix step sees.
FAN = 256


def _ranged(df: DataFrame, order: Sequence[str]) -> Written:
    """Rows range-partitioned and sorted by ``order`` with their partition number, written once."""
    return write_once(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
    )


def _levels(spark: SparkSession) -> int:
    """Steps of ``FAN`` that lead from one range partition to all of them."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    most, levels = max(int(spark.conf.get(k, None) or 1) for k in keys), 1
    while FAN**levels < most:
        levels += 1
    return levels


def _before(blocks: DataFrame, combine: Callable[[str, str], Column], pick: Callable[[str, Window], Column], ahead: bool = False) -> DataFrame:
    """For each range partition, what ``pick`` says of the blocks before it (or after it), one column per level.

    ``blocks`` holds a partition number and a ``_block`` value per range partition. Level 0 compares a partition with
    its neighbours among ``FAN``, level 1 their blocks with each other, and so on: a prefix over all partitions
    is put together from one window per level, in which no task sees more than ``FAN`` rows of a block.
    """
    out = blocks.select(_PID)
    for level in range(_levels(blocks.sparkSession)):
        unit = F.floor(F.col(_PID) / F.lit(FAN**level))
        at = blocks.groupBy(unit.alias("_unit")).agg(combine("_block", _PID).alias("_block"))
        order = F.col("_unit").desc() if ahead else F.col("_unit")
        among = Window.partitionBy(F.floor(F.col("_unit") / F.lit(FAN))).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        found = at.select(F.col("_unit"), pick("_block", among).alias(f"_level{level}"))
        # At most one row per range partition, and their number is a setting.
        out = out.withColumn("_unit", unit).join(F.broadcast(found), "_unit").drop("_unit")
    return out


def _sums_before(sizes: DataFrame) -> DataFrame:
    """(partition, rows in all partitions before it) from (partition, rows)."""
    levels = _before(sizes.withColumnRenamed(_N, "_block"), lambda v, _: F.sum(v), lambda v, w: F.sum(v).over(w))
    total = F.lit(0).cast("long")
    for c in levels.columns[1:]:
        total = total + F.coalesce(F.col(c), F.lit(0).cast("long"))
    return levels.select(_PID, total.alias(_N))


def _edges_before(edges: DataFrame, ahead: bool = False) -> DataFrame:
    """(partition, last ``_block`` of the partitions before it that have one); the first one after it if ``ahead``."""
    pick = F.min_by if ahead else F.max_by
    there = lambda v, pid: F.when(F.col(v).isNotNull(), F.col(pid))
    levels = _before(edges, lambda v, pid: pick(v, there(v, pid)), lambda v, w: F.last(v, ignorenulls=True).over(w), ahead)
    return levels.select(_PID, F.coalesce(*levels.columns[1:]).alias("_edge"))


def row_numbers(df: DataFrame, order: Sequence[str], output: str = "row_index") -> DataFrame:
    """0-based position of every row in the global order of ``order``.

    One range shuffle and one write. The position inside a partition comes from the row counter of
    ``monotonically_increasing_id``; the offsets of the partitions are a prefix sum over them.
    """
    placed = write_once(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_PID, F.shiftright(_POS, 33))
        .withColumn(_POS, F.col(_POS).bitwiseAND(F.lit((1 << 33) - 1)))
    ).rows
    sizes = placed.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    return (
        placed.join(F.broadcast(_sums_before(sizes)), _PID)
        .withColumn(output, F.col(_N) + F.col(_POS))
        .drop(_PID, _POS, _N)
    )


def sums_before(df: DataFrame, order: Sequence[str], value: str, output: str) -> DataFrame:
    """The sum of ``value`` over all rows that sort before a row; rows equal in ``order`` sort freely."""
    ranged = _ranged(df, order).rows
    upto = Window.partitionBy(_PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(_PID).agg(F.sum(value).alias(_N))
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(upto), F.lit(0)))
    return local.join(F.broadcast(_sums_before(sizes)), _PID).withColumn(output, F.col(_N) + F.col("_local")).drop(_PID, _N, "_local")


def interval_values(points: DataFrame, at: str, intervals: DataFrame, start: str, value: str, output: str) -> DataFrame:
    """Each point with the value of the interval it lies in: the last one that starts at the point or before it.

    Points and starts are ranged together and a value is carried forward, within a partition by a window and over
    partitions by their edges. Points at one place are spread over partitions, so neither a wide interval nor
    a place that most points share goes to one task.
    """
    columns = points.columns
    rows = points.select(F.struct(*columns).alias("_row"), F.col(at).cast("long").alias("_at"), F.lit(1).alias("_kind"), F.xxhash64(*columns).alias("_tie"))
    starts = intervals.select(F.col(start).cast("long").alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), F.struct(F.col(value).alias("v")).alias("_value"))
    order = ["_at", "_kind", "_tie"]
    ranged = _ranged(rows.unionByName(starts, allowMissingColumns=True), order).rows
    upto = Window.partitionBy(_PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    edges = ranged.groupBy(_PID).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_at"))).alias("_block"))
    local = ranged.withColumn("_local", F.last("_value", ignorenulls=True).over(upto)).where("_kind = 1")
    carried = local.join(F.broadcast(_edges_before(edges)), _PID)
    return carried.select("_row.*", F.coalesce("_local", "_edge")["v"].alias(output))


def ntile_of_position(position: Column, total: Column, k: int) -> Column:
    """SQL NTILE from a 0-based position: the first ``total % k`` tiles get one row more."""
    small = F.floor(total / F.lit(k)).cast("long")
    big = F.pmod(total, F.lit(k))
    head = big * (small + 1)
    # In the second branch small > 0, because head covers every row when total < k.
    return (
        F.when(position < head, F.floor(position / (small + 1)) + 1)
        .otherwise(big + F.floor((position - head) / F.greatest(small, F.lit(1))) + 1)
        .cast("long")
    )


def global_ntile(df: DataFrame, k: int, order: Sequence[str], output: str = "tile") -> DataFrame:
    """``ntile(k) over (order by order)`` with exact tile sizes; ties not covered by ``order`` are free."""
    if k < 1:
        raise ValueError("the number of tiles must be at least 1")
    numbered = row_numbers(df, order, "_tile_position")
    total = numbered.agg(F.count(F.lit(1)).alias("_tile_total"))
    return (
        numbered.crossJoin(F.broadcast(total))
        .withColumn(output, ntile_of_position(F.col("_tile_position"), F.col("_tile_total"), k))
        .drop("_tile_position", "_tile_total")
    )


def dense_codes(df: DataFrame, column: str, output: str = "code") -> DataFrame:
    """``dense_rank() over (order by column) - 1`` per distinct value, NULL last: (column, n, output)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    flagged = counts.withColumn("_is_null", F.col(column).isNull())
    return row_numbers(flagged, ["_is_null", column], output).drop("_is_null")


# Wanted 0-based ranks, given the number of rows of a series and of those with a value.
Ranks = Callable[[int, int], Iterable[int]]
# Rank -> (values of the row, how many rows lie before the first row equal to it, how many are equal).
Found = dict[int, tuple[tuple, int, int]]
# Series that together have no more rows than this are numbered in one task each.
SHORT_RUN = 1_000_000
# Up to so many runs of equal values have sketches of their own.
SKETCHED_RUNS = 32
# Up to so many tile borders are compared one by one.
CASE_BORDERS = 32


def order_statistics(
    df: DataFrame, order: Sequence[str], ranks: dict[str, Ranks], series: str, missing: str | None = None
) -> dict[str, tuple[int, int, Found]]:
    """Exact rows at given ranks of several series in one pass: {series: (rows, rows with a value, found)}.

    ``df`` holds one row per observation: the series name and the ``order`` columns, among them a
    ``missing`` flag if some observations have no value. Equal rows are counted first (a map-side
    combine), so a value that fills a third of the table is one row when the sort begins. What reaches
    the driver is one number per range partition and one row per wanted rank.
    """
    counted = df.groupBy(series, *order).agg(F.count(F.lit(1)).alias(_N))
    written = _ranged(counted, [series, *order])
    ranged = written.rows
    present = F.sum(F.when(F.col(missing), 0).otherwise(F.col(_N))) if missing else F.sum(_N)
    starts: dict[str, list[tuple[int, int]]] = {}
    totals: dict[str, int] = dict.fromkeys(ranks, 0)
    with_value: dict[str, int] = dict.fromkeys(ranks, 0)
    sizes = ranged.groupBy(series, _PID).agg(F.sum(_N).alias(_N), present.alias("_present")).collect()
    for row in sorted(sizes, key=lambda r: (r[series], r[_PID])):
        name = row[series]
        starts.setdefault(name, []).append((totals[name], row[_PID]))
        totals[name] += row[_N]
        with_value[name] += row["_present"]
    wanted = []
    for name, pids in starts.items():
        offsets = [offset for offset, _ in pids]
        for rank in sorted(set(ranks[name](totals[name], with_value[name]))):
            offset, pid = pids[bisect_right(offsets, rank) - 1]
            wanted.append((name, pid, offset, rank))
    result: dict[str, tuple[int, int, Found]] = {n: (totals[n], with_value[n], {}) for n in ranks}
    if not wanted:
        written.delete()
        return result
    requests = df.sparkSession.createDataFrame(wanted, f"{series} string, {_PID} int, _offset long, _rank long")
    needed = sorted({pid for _, pid, _, _ in wanted})
    inside = Window.partitionBy(series, _PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        ranged.where(F.col(_PID).isin(needed))
        .withColumn("_upto", F.sum(_N).over(inside))
        .join(F.broadcast(requests), [series, _PID])
        .withColumn("_before", F.col("_offset") + F.col("_upto") - F.col(_N))
        .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col(_N)))
        .select(series, "_rank", "_before", _N, *order)
        .collect()
    )
    for row in hits:
        result[row[series]][2][row["_rank"]] = (tuple(row[c] for c in order), row["_before"], row[_N])
    written.delete()
    return result


def _value(df: DataFrame, column: str) -> Column:
    """The column as a double with one zero, so that -0.0 and 0.0 are the same value.

    Long integers and decimals stay as they are where different ones can be the same double.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.LongType) or (isinstance(kind, T.DecimalType) and kind.precision > 15):
        return F.col(column)
    return F.col(column).cast("double") + F.lit(0.0)


def _literal(df: DataFrame, column: str, value: object) -> Column:
    """A value found in a column, in the type in which ``_value`` compares."""
    kind = df.schema[column].dataType
    return F.lit(value).cast(kind if isinstance(kind, (T.LongType, T.DecimalType)) and not isinstance(value, float) else "double")


# How close the sketch comes (one part of so many rows), and the shares of the rows that it is asked for.
SKETCH_ACCURACY, SKETCH_STEPS = 5_000, 500


@dataclass
class Bracket:
    """Values from ``low`` to ``high`` (None: no bound) that hold the rows of some ranks."""

    low: object
    high: object
    ranks: list[int]
    below: int = 0
    inside: int = 0

    def holds(self, x: Column, literal: Callable[[object], Column]) -> Column:
        found = x.isNotNull()
        if self.low is not None:
            found = found & (x >= literal(self.low))
        return found & (x <= literal(self.high)) if self.high is not None else found


def _brackets(steps: list | None, present: int, wanted: Iterable[int]) -> list[Bracket]:
    """Where a sketch's values put the wanted ranks, with room for its error; overlapping brackets are one."""
    steps = [v for v in steps or () if not (isinstance(v, float) and isnan(v))]
    slack, out = present / SKETCH_ACCURACY + 1, []
    for rank in sorted(wanted):
        first = floor((rank - slack) / present * SKETCH_STEPS) - 1
        last = ceil((rank + 1 + slack) / present * SKETCH_STEPS) + 1
        low = steps[min(first, len(steps) - 1)] if first >= 0 and steps else None
        out.append(Bracket(low, steps[last] if last < len(steps) else None, [rank]))
    return _merged(out)


def _merged(brackets: list[Bracket]) -> list[Bracket]:
    out: list[Bracket] = []
    for b in brackets:
        if out and (b.low is None or out[-1].high is None or b.low <= out[-1].high):
            last = out[-1]
            last.low = None if b.low is None or last.low is None else min(last.low, b.low)
            last.high = None if last.high is None or b.high is None else max(last.high, b.high)
            last.ranks = sorted({*last.ranks, *b.ranks})
        else:
            out.append(b)
    return out


# Rank -> (value, how many rows lie before the first row of that value, how many rows have it).
FoundValues = dict[int, tuple[object, int, int]]


def ranked_values(df: DataFrame, ranks: dict[str, Ranks]) -> dict[str, tuple[int, int, FoundValues]]:
    """Exact values at given ranks of several columns: {column: (rows, rows with a value, found)}; NULLs come last.

    One scan builds a mergeable sketch of every column, which brackets the wanted ranks. A second scan counts
    the rows below and inside every bracket, so that a bracket which misses its rank is seen and widened. Only
    rows inside a bracket are then counted by value, ranged and sorted; a bracket of one value needs not even that. What is
    moved is a few thousandths of a column for each rank, and nothing of the table is reshaped.
    """
    columns = list(ranks)
    if not columns:
        return {}
    steps = ", ".join(f"{i / SKETCH_STEPS!r}D" for i in range(SKETCH_STEPS + 1))
    values = df.select(*[_value(df, c).alias(f"x{i}") for i, c in enumerate(columns)])
    row = values.agg(F.count(F.lit(1)).alias("n"), *[
        made for i in range(len(columns))
        for made in (F.count(f"x{i}").alias(f"n{i}"), F.expr(f"percentile_approx(x{i}, array({steps}), {SKETCH_ACCURACY})").alias(f"s{i}"))
    ]).first()
    found: dict[str, tuple[int, int, FoundValues]] = {}
    brackets: dict[str, list[Bracket]] = {}
    for i, c in enumerate(columns):
        n, present = row["n"], row[f"n{i}"]
        wanted = set(ranks[c](n, present))
        found[c] = (n, present, {r: (None, present, n - present) for r in wanted if r >= present})
        brackets[c] = _brackets(row[f"s{i}"], present, [r for r in wanted if r < present])
    literal = {c: (lambda v, c=c: _literal(df, c, v)) for c in columns}
    open_ones = [(i, c, b) for i, c in enumerate(columns) for b in brackets[c]]
    while open_ones:
        counts = []
        for i, c, b in open_ones:
            x = F.col(f"x{i}")
            counts += [F.count_if(x < literal[c](b.low)) if b.low is not None else F.lit(0).cast("long"), F.count_if(b.holds(x, literal[c]))]
        row = values.agg(F.count(F.lit(1)), *counts).first()[1:]
        for (i, c, b), below, inside in zip(open_ones, row[::2], row[1::2]):
            b.below, b.inside = below, inside
        missed = {c for _, c, b in open_ones if b.ranks[0] < b.below or b.ranks[-1] >= b.below + b.inside}
        for c in missed:
            for b in brackets[c]:
                b.low = None if b.ranks[0] < b.below else b.low
                b.high = None if b.ranks[-1] >= b.below + b.inside else b.high
            brackets[c] = _merged(brackets[c])
        open_ones = [(i, c, b) for i, c in enumerate(columns) if c in missed for b in brackets[c]]
    by_type: dict[str, list[tuple[str, str, Bracket]]] = {}
    for i, c in enumerate(columns):
        for j, b in enumerate(brackets[c]):
            if b.low is not None and b.low == b.high:
                found[c][2].update({r: (b.low, b.below, b.inside) for r in b.ranks})
            else:
                by_type.setdefault(values.schema[f"x{i}"].dataType.simpleString(), []).append((f"x{i}", f"{c}#{j}", b))
    for group in by_type.values():
        of_series = {series: (columns[int(x[1:])], b) for x, series, b in group}
        # The brackets of a column don't overlap, so a row is in one of them at most. One scan finds the rows of all columns.
        entries = []
        for x in dict.fromkeys(x for x, _, _ in group):
            in_series = F.coalesce(*[F.when(b.holds(F.col(x), literal[of_series[series][0]]), F.lit(series)) for y, series, b in group if y == x])
            entries.append((in_series, F.when(in_series.isNotNull(), F.struct(in_series.alias("series"), F.col(x).alias("value")))))
        some = values.where(F.coalesce(*[s for s, _ in entries]).isNotNull())
        inside = some.select(F.inline(F.array_compact(F.array(*[e for _, e in entries]))))
        wanted = {series: [r - b.below for r in b.ranks] for series, (_, b) in of_series.items()}
        for series, at in _at_places(inside, ["value"], wanted, sum(b.inside for _, b in of_series.values())).items():
            c, b = of_series[series]
            found[c][2].update({r + b.below: (value, before + b.below, equal) for r, ((value,), before, equal) in at.items()})
    return found


def tile_starts(n: int, k: int) -> list[int]:
    """0-based rank at which tiles 2..k begin; tiles beyond the row count do not begin."""
    small, big = divmod(n, k)
    starts = [i * small + min(i, big) for i in range(1, k)]
    return [s for s in starts if s < n]


class DuplicateKey(ValueError):
    """The key given as unique is not."""


# Value at which a tile begins, and the first columns of its first key when rows with that value straddle it.
Border = tuple[float | None, tuple | None]


def column_ranks(
    df: DataFrame, shares: dict[str, Sequence[float]], tiles: dict[str, Sequence[int]], key: Sequence[str] = ()
) -> tuple[dict[tuple[str, float], float | None], dict[tuple[str, int], list[Border]]]:
    """Exact percentiles and NTILE borders of numeric columns, all selected together.

    Percentiles are ``percentile_cont`` over the values; the built-in exact one holds every distinct
    value of the table in one task. With the borders of a tile known, the tile of a row is a comparison,
    so the wide table is never sorted or shuffled. NULLs sort last. Rows with equal values are split by
    the unique ``key``; only rows whose value straddles a border (at most k - 1 values per column) take
    part in the second pass.
    """
    for column, wanted in shares.items():
        if any(not 0 <= p <= 1 for p in wanted):
            raise ValueError(f"percentiles of {column} must lie between 0 and 1")
    columns = list(dict.fromkeys([*shares, *tiles]))

    def ranks_of(column: str) -> Ranks:
        def ranks(n: int, present: int) -> set[int]:
            low = [int(p * (present - 1)) for p in shares.get(column, ()) if present]
            high = [min(r + 1, present - 1) for r in low]
            return {*low, *high, *(s for k in tiles.get(column, ()) for s in tile_starts(n, k))}

        return ranks

    first = ranked_values(df, {c: ranks_of(c) for c in columns})
    percentiles: dict[tuple[str, float], float | None] = {}
    for column, wanted in shares.items():
        _, present, found = first[column]
        for p in wanted:
            if present == 0:
                percentiles[column, p] = None
                continue
            at = p * (present - 1)
            low, high = (found[r][0] for r in (int(at), min(int(at) + 1, present - 1)))
            low, high = (float(v) if isinstance(v, (int, Decimal)) else v for v in (low, high))
            percentiles[column, p] = low + (high - low) * (at - int(at))
    # Tiles whose start falls inside a run of equal values: find the key at that place in the run.
    runs: dict[Run, dict[int, int]] = {}
    sizes: dict[Run, int] = {}
    for column, ks in tiles.items():
        n, _, found = first[column]
        for start in {s for k in ks for s in tile_starts(n, k)}:
            value, before, equal = found[start]
            if start > before:
                sizes[column, value, ()] = equal
                runs.setdefault((column, value, ()), {})[start - before] = start
    first_keys = _split_runs(df, runs, sizes, list(key))
    borders = {
        (column, k): [
            (first[column][2][start][0], first_keys.get((column, start)))
            for start in tile_starts(first[column][0], k)
        ]
        for column, ks in tiles.items() for k in ks
    }
    return percentiles, borders


# Rows of one value of a column whose first key columns are known: (column, value, known keys).
Run = tuple[str, float | None, tuple]


def _split_runs(
    df: DataFrame, runs: dict[Run, dict[int, int]], sizes: dict[Run, int], key: list[str]
) -> dict[tuple[str, int], tuple]:
    """The key of the row at each wanted place of each run: {(column, rank of that row): first key columns}.

    The first key column is ranked alone, by a sketch if it holds integers and else counted and sorted, which leaves just
    the rows that share its value at a wanted place; those are few unless that value is hot, and are ordered by the rest
    of the key. A key is as long as it takes to tell the row from the one before it.
    """
    found: dict[tuple[str, int], tuple] = {}
    depth = 0
    while runs:
        if depth == len(key):
            raise DuplicateKey(f"the columns {', '.join(key) or '()'} do not tell all rows apart")
        names = {run: f"run{i}" for i, run in enumerate(runs)}
        rows = sum(sizes.values())
        rest = key[:1] if depth == 0 and rows > SHORT_RUN else key[depth:]
        wanted = {names[run]: list(places) for run, places in runs.items()}
        if depth == 0 and rows > SHORT_RUN and len(runs) <= SKETCHED_RUNS and isinstance(df.schema[key[0]].dataType, T.IntegralType):
            at = _key_at_places(df, names, key[0], wanted, sizes)
        else:
            at = _at_places(_tagged(df, names, key[:depth], rest), rest, wanted, rows)
        longer: dict[Run, dict[int, int]] = {}
        sizes = {}
        for (column, value, known), places in runs.items():
            for place, rank in places.items():
                values, before, equal = at[names[column, value, known]][place]
                if place == before:
                    found[column, rank] = known + values
                else:
                    run = (column, value, known + values)
                    sizes[run] = equal
                    longer.setdefault(run, {})[place - before] = rank
        runs, depth = longer, depth + len(rest)
    return found


def _key_at_places(df: DataFrame, names: dict[Run, str], key: str, places: dict[str, list[int]], sizes: dict[Run, int]) -> dict[str, Found]:
    """As ``order_statistics`` of an integer key column in each run, NULLs first: the key is ranked as a column per run."""
    in_run = [F.when(_value(df, c).eqNullSafe(F.lit(None) if v is None else _literal(df, c, v)), F.col(key).cast("long")).alias(name) for (c, v, _), name in names.items()]

    def ranks_of(run: Run) -> Ranks:
        return lambda n, present: {p - (sizes[run] - present) for p in places[names[run]] if p >= sizes[run] - present}

    result: dict[str, Found] = {}
    ranked = ranked_values(df.select(*in_run), {name: ranks_of(run) for run, name in names.items()})
    for run, name in names.items():
        _, present, found = ranked[name]
        nulls = sizes[run] - present
        result[name] = {p: ((None,), 0, nulls) if p < nulls else ((found[p - nulls][0],), found[p - nulls][1] + nulls, found[p - nulls][2]) for p in places[name]}
    return result


def _tagged(df: DataFrame, names: dict[Run, str], known: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """The rows of each run with its name as ``series``; there are at most as many runs as tile borders."""
    parts = []
    for column in dict.fromkeys(c for c, _, _ in names):
        x = _value(df, column)
        fields = [T.StructField("_run", df.select(x.alias("x")).schema["x"].dataType), *(T.StructField(f"_known{i}", df.schema[c].dataType) for i, c in enumerate(known)),
                  T.StructField("series", T.StringType())]
        runs = df.sparkSession.createDataFrame([(v, *k, name) for (c, v, k), name in names.items() if c == column], T.StructType(fields))
        same = x.eqNullSafe(F.col("_run"))
        for i, c in enumerate(known):
            same = same & F.col(c).eqNullSafe(F.col(f"_known{i}"))
        parts.append(df.join(F.broadcast(runs), same).select("series", *rest))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _at_places(rows: DataFrame, order: Sequence[str], places: dict[str, list[int]], n: int) -> dict[str, Found]:
    """As ``order_statistics`` at given places of series that together have ``n`` rows.

    Up to ``SHORT_RUN`` rows are numbered by a window over each series; more are ranged.
    """
    if n > SHORT_RUN:
        wanted = {name: (lambda n, present, at=at: at) for name, at in places.items()}
        return {name: hits for name, (_, _, hits) in order_statistics(rows, order, wanted, "series").items()}
    counted = rows.groupBy("series", *order).agg(F.count(F.lit(1)).alias(_N))
    upto = Window.partitionBy("series").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("_before", F.sum(_N).over(upto) - F.col(_N))
    requests = rows.sparkSession.createDataFrame([(name, p) for name, at in places.items() for p in at], "series string, _place long")
    hits = counted.join(F.broadcast(requests), "series").where((F.col("_place") >= F.col("_before")) & (F.col("_place") < F.col("_before") + F.col(_N)))
    result: dict[str, Found] = {name: {} for name in places}
    for row in hits.select("series", "_place", "_before", _N, *order).collect():
        result[row["series"]][row["_place"]] = (tuple(row[c] for c in order), row["_before"], row[_N])
    return result


def percentiles(df: DataFrame, wanted: dict[str, Sequence[float]]) -> dict[tuple[str, float], float | None]:
    """{(column, share): exact percentile_cont} of several columns in one pass over the table."""
    return column_ranks(df, wanted, {})[0]


_AS_JSON = (T.NumericType, T.StringType, T.BooleanType, T.DateType)


def _constant(rows: list[dict], kind: T.ArrayType) -> Column:
    """An array of structs as one constant; written field by field where a type has no exact text."""
    if all(isinstance(f.dataType, _AS_JSON) for f in kind.elementType):
        return F.from_json(F.lit(json.dumps(rows, default=str)), kind)
    return F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in kind.elementType]) for r in rows])


def ntile_column(df: DataFrame, column: str, borders: Sequence[Border], key: Sequence[str]) -> Column:
    """The tile of each row from the borders: 1 + the number of tile starts at or before the row.

    A few borders are a sum of comparisons; more are searched by halving, in an array that every task holds.
    """
    x = _value(df, column)
    known = key[: max((len(k) for _, k in borders if k), default=0)]
    if len(borders) > CASE_BORDERS:
        # A border is a row that sorts at or before all rows of its tile: NULLs of a key sort first, those of the column last.
        named = lambda columns: F.struct(*[c.alias(f"f{i}") for i, c in enumerate(columns)])
        kind = df.select(named([x.isNull(), x, *map(F.col, known)]).alias("r")).schema["r"].dataType
        fields = [(v is None, v, *(k or ()), *[None] * (len(known) - len(k or ()))) for v, k in borders]
        sorted_borders = _constant([dict(zip(kind.names, f)) for f in fields], T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in kind])))
        kind = T.StructType([T.StructField(f.name, f.dataType) for f in kind])
        steps = [1 << i for i in reversed(range(len(borders).bit_length()))]
        me = named([x.isNull(), x, *map(F.col, known)]).cast(kind)
        reached = lambda n: F.when(n <= len(borders), F.element_at(sorted_borders, F.least(n, F.lit(len(borders)))) <= me).otherwise(F.lit(False))
        found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(reached(at + step), at + step).otherwise(at))
        return (found + 1).cast("long")
    tile = F.lit(1).cast("long")
    for value, first_key in borders:
        if value is None:
            after, equal = F.lit(False), x.isNull()
        else:
            after, equal = x.isNull() | (x > _literal(df, column, value)), x.eqNullSafe(_literal(df, column, value))
        if first_key is not None:
            mine = key[:len(first_key)]
            fields = [F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(mine, first_key)]
            equal = equal & (F.struct(*mine) >= F.struct(*fields))
        tile = tile + F.when(after | equal, F.lit(1)).otherwise(F.lit(0))
    return tile


def neighbour(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, output: str, ahead: bool = False
) -> DataFrame:
    """``lag``/``lead`` of ``value`` per group, where a group may be most of the table.

    A window over the group alone sorts the whole group in one task. Rows are range-partitioned by
    (group, order) instead, the window runs inside each partition, and the one row missing at each
    partition edge comes from the nearest partition on that side that has rows. Rows equal
    on (group, order) sit in one partition, so callers count equal rows first.
    """
    columns = [*group, *order]
    ranged = _ranged(df, columns).rows
    inside = Window.partitionBy(_PID, *group).orderBy(*order)
    shifted = F.lead if ahead else F.lag
    # Carry a struct, so that a NULL value and a missing neighbour stay apart.
    local = ranged.withColumn("_local", shifted(F.struct(F.col(value).alias("v"))).over(inside))
    pick = F.min_by if ahead else F.max_by
    edge = ranged.groupBy(_PID).agg(
        pick(F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group)], F.col(value).alias("v")),
             F.struct(*columns)).alias("_block")
    )
    edges = _edges_before(edge, ahead)
    same = F.col("_edge").isNotNull()
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_edge.g{i}"))
    return (
        local.join(F.broadcast(edges), _PID)
        .withColumn(
            output,
            F.when(F.col("_local").isNotNull(), F.col("_local.v")).when(same, F.col("_edge.v")),
        )
        .withColumn(f"{output}_exists", F.col("_local").isNotNull() | same)
        .drop("_local", "_edge", _PID)
    )
