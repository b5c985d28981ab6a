"""Jaccard join of texts on word shingles: size-banded tiles, bitmap bounds, exact intersection.

A text's set is the hashes of its distinct ``WORDS``-word shingles; texts with equal sets form a class, and
only classes are compared. Two sets that link share one of the shingles that come first in a common order
(a quarter of each set), so classes meet in the tiles of those shingles. The work takes two steps:

1. Neighbours in each tile are checked. In groups of near copies this connects almost all members with about as
   many checks as members.
2. Tiles that hold classes of different components are cut into bands of similar size, first for the nearest
   pairs of two components, then for all pairs of those components that had more than one and that the nearest
   has not joined. In each band
   pairs of different components are bounded from above: with bitmaps in which every shingle flips one bit,
   the bits that differ are at most the shingles that differ. Pairs that pass are intersected exactly.

Pairs of classes that step 1 has connected are not compared again, so no pairs within a group of copies
are emitted. The order puts shingles that are common in a bounded sample last; it decides the work only,
results are exact for any order.

Cases: a null or empty text, or one without words, has an empty set and is linked with nothing. A text of
fewer than ``WORDS`` words has one shingle, the whole. Repeated rows are in one class. Rows with a null id
are linked like others; a component of such rows alone has a null id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T
from millrace.llm.columns import release_shuffles, shield
from millrace.llm.graph import components
from millrace.session import write_once

WORDS = 5
#: Link where 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Expected number of texts whose shingles decide which ones count as common, and most such shingles kept.
ORDER_SAMPLE, COMMON_KEPT = 3000, 50_000
#: Sets of more shingles go without bitmaps in the tiles; their shared tiles are counted instead.
LARGE = 16_000
#: Tile groups of so many rows at most are paired all at once, larger ones one by one.
SMALL_GROUP = 12
#: Rows of a block: larger groups of a tile are cut into blocks, and pairs of blocks are spread over tasks.
DEAL = 4096
#: Pairs of a tile that are looked at together: so many rows by so many partners.
ROWS_AT_ONCE, PARTNERS_AT_ONCE = 64, 2048
#: Rows of tiles that a task holds at a time (whole groups), and pairs that it keeps before it hands them on.
ROWS_HELD, PAIRS_HELD = 1 << 15, 1 << 19
#: Parts that the rows of a common tile, or of one component, are dealt to.
PARTS = 64
#: Bits of the set of classes whose shingles are read for exact checks; a fuller set reads more of them.
SET_BITS = 23


def _sets(data: np.ndarray, offsets: np.ndarray, n_words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text of a group, and where each text's shingles begin."""
    n = len(offsets) - 1
    w = T.words(data, offsets, T.SPACED)
    h = T.hashes(data, w.start, w.end, fold=True)
    gram, at = T.grams(h, w.first, n_words)
    text = w.text[at]
    few = np.flatnonzero((w.per_text > 0) & (w.per_text < n_words))
    if len(few):
        grams, texts = [gram], [text]
        for size in range(1, n_words):
            rows = few[w.per_text[few] == size]
            if len(rows):
                one, one_at = T.grams(h, w.first, size)
                grams.append(one[np.searchsorted(one_at, w.first[rows])])
                texts.append(rows)
        gram, text = np.concatenate(grams), np.concatenate(texts)
    order = np.lexsort((gram, text))
    gram, text = gram[order], text[order]
    if len(gram):
        new = np.ones(len(gram), dtype=bool)
        new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
        gram, text = gram[new], text[new]
    return gram, np.searchsorted(text, np.arange(n + 1))


def _classes(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for empty sets."""
    total = np.zeros(len(gram) + 1, dtype=np.uint64)
    np.cumsum(T.mix(gram), out=total[1:])
    n = np.diff(first).astype(np.uint64)
    return np.where(n > 0, T.mix(total[first[1:]] - total[first[:-1]] + n) | np.uint64(1), np.uint64(0))


def _bitmap(one: np.ndarray) -> bytes:
    """Every shingle flips one bit; there are more bits than shingles (a power of two, 64 at least).

    Small sets get the most: with few bits those that just miss a link would all pass. With three bits a shingle,
    sets that share seven tenths still show more differing bits than a link allows.
    """
    bits = 1 << max(6, (3 * len(one) if len(one) <= 340 else 13 * len(one) // 10).bit_length())
    return np.packbits((np.bincount((one & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool)).tobytes()


def _hashed(documents: DataFrame) -> DataFrame:
    """The texts with a hash of each, by which a text is found again without making its shingles."""
    return documents.filter("text is not null").select("text", F.xxhash64("text").alias("hash"))


def _text_of(batch: pa.RecordBatch) -> pa.Array:
    return batch.column(batch.schema.get_field_index("text"))


def class_of(documents: DataFrame) -> DataFrame:
    """All columns but the text, with ``_n`` (size of the set) , ``_class`` (null if empty) and ``_bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for low, high, data, offsets in T.chunks(batch.column(at)):
                gram, first = _sets(data, offsets)
                key = _classes(gram, first)
                bits = [_bitmap(gram[first[i] : first[i + 1]]) if key[i] else None for i in range(high - low)]
                part = batch.slice(low, high - low)
                columns = [c for i, c in enumerate(part.columns) if i != at]
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.diff(first), pa.int64()), pa.array(key.view(np.int64), mask=key == 0), pa.array(bits, pa.binary())],
                    names=[*names, "_n", "_class", "_bits"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name != "text"]
    return documents.mapInArrow(run, ", ".join([*kept, "_n bigint, _class bigint, _bits binary"]))


def _common(texts: DataFrame, n_rows: int) -> np.ndarray:
    """Shingles of one in a thousand sampled sets or more; the driver gets at most ``COMMON_KEPT`` of them."""
    part = min(1.0, ORDER_SAMPLE / max(n_rows, 1))
    chosen = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(part * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in T.chunks(_text_of(batch)):
                gram, first = _sets(data, offsets)
                key = np.repeat(_classes(gram, first), np.diff(first))
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(key.view(np.int64))], names=["gram", "key"])

    counts = chosen.mapInArrow(run, "gram long, key long").distinct().groupBy("gram").count()
    least = max(4, ORDER_SAMPLE // 1000)
    rows = counts.filter(F.col("count") >= least).orderBy(F.desc("count"), "gram").limit(COMMON_KEPT).select("gram").collect()
    return np.sort(np.array([r.gram for r in rows], dtype=np.int64).view(np.uint64))


def _shares(n: np.ndarray) -> np.ndarray:
    """So many of their leading shingles two sets that link share at least, for the smaller of the two numbers.

    Each further shared one costs one more leading shingle. Large sets meet by chance in many tiles, and
    their bitmaps are too long for tiles, so of them more are asked for.
    """
    return np.where(n > LARGE, n // 50, 1)


def _leading(texts: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """Tile, class and size: for every class the shingles that come first in the common order.

    ``part`` deals the rows of a common tile to ``PARTS`` parts by their class; it is 0 for other tiles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task; a copy adds nothing to the tiles
        likely = np.zeros(1 << 20, dtype=bool)
        likely[(common >> np.uint64(44)).astype(np.int64)] = True
        for batch in batches:
            for _, _, data, offsets in T.chunks(_text_of(batch)):
                gram, first = _sets(data, offsets)
                key, n = _classes(gram, first), np.diff(first)
                new = np.array([k != 0 and k not in seen and not seen.add(k) for k in key.tolist()], dtype=bool)
                text = np.repeat(np.arange(len(n)), n)
                mine = new[text]
                gram, text = gram[mine], text[mine]
                late = likely[(gram >> np.uint64(44)).astype(np.int64)]
                at = np.flatnonzero(late)
                late[at] = common[np.minimum(np.searchsorted(common, gram[at]), len(common) - 1)] == gram[at] if len(common) else False
                order = np.lexsort((late, text))  # stable, so shingles stay in order of their hash
                gram, text = gram[order], text[order]
                place = np.arange(len(text)) - np.searchsorted(text, text)
                lead = place < (n - -(-percent * n // 100) + _shares(n))[text]
                part = np.where(late[order][lead], T.mix(key[text[lead]]) % np.uint64(PARTS), np.uint64(0))
                gram, text = gram[lead], text[lead]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(key[text].view(np.int64)), pa.array(n[text], pa.int32()),
                     pa.array(part.astype(np.int32)), pa.array(late[order][lead])],
                    names=["tile", "class", "n", "part", "common"])

    return texts.mapInArrow(run, "tile long, class long, n int, part int, common boolean")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of tiles with two classes or more, each once. Of common tiles, whose rows are in several tasks, all stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if not parts:
            return
        tile, key, n, common = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((key, tile))
        tile, key, n, common = tile[order], key[order], n[order], common[order]
        new = np.ones(len(tile), dtype=bool)
        new[1:] = (tile[1:] != tile[:-1]) | (key[1:] != key[:-1])
        tile, key, n, common = tile[new], key[new], n[new], common[new]
        both = np.zeros(len(tile) + 1, dtype=bool)
        both[1:-1] = tile[1:] == tile[:-1]
        keep = both[1:] | both[:-1] | common
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (tile, key, n)], names=["tile", "class", "n"])

    rows = rows.repartition("tile", "part").select("tile", "class", "n", "common")
    return rows.mapInArrow(run, "tile long, class long, n int")


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap of fewer bits, in which still every shingle flips one."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _most_differing(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """So many shingles may be in one of two sets only: |x & y| >= p / (100 + p) * (|x| + |y|)."""
    return (n + m) * (100 - percent) // (100 + percent)


def _bounded(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes (a, b) whose bitmaps allow a link; ``bits`` has class, n and bits."""
    for side in ("a", "b"):
        pairs = pairs.join(bits.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            most = _most_differing(batch.column(2).to_numpy(), batch.column(4).to_numpy(), percent)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in (3, 5))
                width = min(len(x), len(y))
                if np.bitwise_count(_fold(x, width) ^ _fold(y, width)).sum() <= most[i]:
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return pairs.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(run, "a long, b long")


def _member_set(wanted: DataFrame) -> np.ndarray:
    """The texts of ``wanted`` as a bit set of fixed size, by their hash."""
    ids = wanted.select(F.shiftrightunsigned("hash", 64 - SET_BITS).alias("bit"))
    rows = ids.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).collect()
    out = np.zeros(1 << (SET_BITS - 6), dtype=np.int64)
    for r in rows:
        out[r["at"]] = r["bits"]
    return out.view(np.uint8)


def _verified(pairs: DataFrame, texts: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes (a, b) that link, by exact intersection of their sorted shingles.

    ``reps`` has the hash of one text of each class; of all texts only those are read into shingles.
    """
    ends = write_once(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(reps, "class"))
    members = _member_set(ends.rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(members, bitorder="little").view(bool)
        seen: set[int] = set()
        for batch in batches:
            mark = batch.column(1).to_numpy().view(np.uint64)
            some = [i for i in np.flatnonzero(known[(mark >> np.uint64(64 - SET_BITS)).astype(np.int64)])
                    if int(mark[i]) not in seen and not seen.add(int(mark[i]))]
            for _, _, data, offsets in T.chunks(batch.column(0).take(pa.array(some, pa.int64()))):
                gram, first = _sets(data, offsets)
                key = _classes(gram, first)
                wanted = np.flatnonzero(key != 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[wanted].view(np.int64)), pa.array([gram[first[i] : first[i + 1]].tobytes() for i in wanted], pa.binary())],
                    names=["class", "grams"])

    sets = _hashed(texts).mapInArrow(read, "class long, grams binary")
    written = write_once(sets.join(ends.rows, "class", "left_semi").groupBy("class").agg(F.first("grams").alias("grams")))
    sets = written.rows
    left = pairs.join(sets.select(F.col("class").alias("a"), F.col("grams").alias("of_a")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("grams").alias("of_b")), "b").select("a", "b", "of_a", "of_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_buffer(), dtype=np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    links = write_once(both.mapInArrow(check, "a long, b long")).rows
    written.delete()
    ends.delete()
    return links


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of tiles in bands, once for each pair of blocks that they are in: ``pair`` (-1 for groups of one block),
    ``side`` (which of the two blocks) and ``same`` (whether the two are one).

    A component that fills a block has blocks of its own, which aren't paired with each other.
    """
    by = ["tile", "band"]
    counts = rows.filter(F.col("members") > DEAL).groupBy(*by, "root").count()
    counts = write_once(counts).rows
    heavy = F.col("count") > DEAL
    blocks = lambda n: F.ceil(n / DEAL).cast("int")
    total = counts.groupBy(*by).agg(F.sum("count").alias("rows"), F.sum(F.when(~heavy, F.col("count"))).alias("light")).filter(F.col("rows") > DEAL)
    total = write_once(total.select(*by, blocks(F.coalesce("light", F.lit(0))).alias("n_light"))).rows
    whole = rows.withColumns({"pair": F.lit(-1).cast("long"), "side": F.lit(False), "same": F.lit(True)})
    if total.isEmpty():
        return whole
    own = write_once(counts.filter(heavy).join(total, by, "left_semi").select(*by, "root", blocks(F.col("count")).alias("n_own"))).rows
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("number")
    every = total.filter("n_light > 0").select(*by, F.lit(None).cast("long").alias("owner"), numbers("n_light")).unionByName(
        own.select(*by, F.col("root").alias("owner"), numbers("n_own")))
    every = every.select(*by, F.struct("owner", "number").alias("block"))
    pairs = every.withColumnRenamed("block", "i").join(every.withColumnRenamed("block", "j"), by)
    # A null owner isn't equal to itself here, so blocks of several components also meet themselves and each other.
    pairs = pairs.filter("i <= j and not coalesce(i.owner = j.owner, false)").withColumn("pair", F.monotonically_increasing_id())
    pairs = write_once(pairs).rows
    one = F.struct(F.col("i").alias("block"), F.lit(False).alias("side"))
    two = F.struct(F.col("j").alias("block"), F.lit(True).alias("side"))
    ends = pairs.select(*by, "pair", (F.col("i") == F.col("j")).alias("same"), F.inline(F.when(F.col("i") == F.col("j"), F.array(one)).otherwise(F.array(one, two))))
    ends = write_once(ends.select(*by, "pair", "same", "side", F.coalesce("block.owner", F.lit(0)).alias("owner"), F.col("block.owner").isNotNull().alias("owned"), F.col("block.number").alias("number"))).rows
    placed = rows.join(total, by).join(own, [*by, "root"], "left")
    placed = placed.withColumns({
        "owned": F.col("n_own").isNotNull(), "owner": F.when(F.col("n_own").isNotNull(), F.col("root")).otherwise(0),
        "number": F.pmod(F.when(F.col("n_own").isNotNull(), F.xxhash64("class")).otherwise(F.xxhash64("root")), F.coalesce("n_own", "n_light")).cast("int")})
    placed = placed.join(ends, [*by, "owner", "owned", "number"]).select(*whole.columns)
    return whole.join(total, by, "left_anti").select(*whole.columns).unionByName(placed)


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str], n_rows: int) -> Iterator[pa.Table]:
    """The rows of sorted batches in tables of about ``n_rows`` rows, each of whole groups."""
    parts: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        parts.append(batch)
        held += batch.num_rows
        if held < n_rows:
            continue
        whole = pa.Table.from_batches(parts)
        differs = np.zeros(whole.num_rows - 1, dtype=bool)
        for column in by:
            differs |= np.diff(whole[column].to_numpy()) != 0
        edges = np.flatnonzero(differs)
        cut = int(edges[-1]) + 1 if len(edges) else 0
        if cut:
            yield whole.slice(0, cut)
        parts, held = whole.slice(cut).to_batches(), whole.num_rows - cut
    if held:
        yield pa.Table.from_batches(parts)


def _banded(rows: DataFrame, bits: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs of classes of different components that may link: rows have tile, members, class, n and root, bits class and bits.

    With ``nearest`` only one near pair of two components of each task, and in ``more`` whether there are others;
    sets without bitmaps have no near pairs.

    A tile's rows go to the band of their size and, as smaller partners, to the next one, so that a tile is
    spread over as many tasks as it has bands, and of a large band over as many as it has pairs of blocks. Two sizes
    that can link differ by one band at most. Tiles that are paired all at once stay whole.
    """
    step = math.log(100 / percent)
    rows = write_once(rows).rows
    rows = rows.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).cast("int"))
    rows = rows.select("tile", "members", "class", "n", "root", F.explode(
        F.when(F.col("members") <= SMALL_GROUP, F.array(F.struct(F.lit(-1).alias("band"), F.lit(True).alias("own"))))
        .otherwise(F.array(F.struct(F.col("band").alias("band"), F.lit(True).alias("own")),
                           F.struct((F.col("band") + 1).alias("band"), F.lit(False).alias("own"))))).alias("to"))
    rows = _dealt(rows.select("tile", F.col("to.band").alias("band"), F.col("to.own").alias("own"), "class", "n", "root", "members"))
    rows = rows.join(bits, "class").select("tile", "band", "own", "class", "n", "root", "bits", "pair", "side", "same")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_groups(batches, ["tile", "band", "pair"], ROWS_HELD):
            yield from some_groups(whole)

    def some_groups(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        tile, band, own, key, n, root = (whole.column(i).to_numpy() for i in range(6))
        n = n.astype(np.int64)
        bits = whole.column(6).combine_chunks()
        deal, side, same_block = (whole.column(i).to_numpy() for i in (7, 8, 9))
        # Every class once: many tiles of a task hold the same ones.
        classes, one, of = np.unique(key, return_index=True, return_inverse=True)
        maps = [np.frombuffer(bits[int(i)].as_py() or b"", dtype=np.uint64) for i in one]
        width = np.array([len(m) for m in maps])
        stacked = {w: np.array([m for m in maps if len(m) == w]) for w in set(width.tolist())}
        slot = np.zeros(len(maps), dtype=np.int64)
        for w in stacked:
            slot[width == w] = np.arange((width == w).sum())
        group_of = root[one]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def add(x: np.ndarray, y: np.ndarray) -> None:
            ok = (root[x] != root[y]) & (100 * n[x] >= percent * n[y]) & (100 * n[y] >= percent * n[x]) & (own[x] | own[y]) & (same_block[x] | (side[x] != side[y]))
            x, y = of[x[ok]], of[y[ok]]
            size = n[one]
            most = _most_differing(size[x], size[y], percent)
            keep = np.full(len(x), not nearest)
            slack = np.zeros(len(x), dtype=np.int64)
            for a in stacked:
                for b in stacked:
                    if not a or not b:
                        continue  # a large set: its pairs are counted
                    at = np.flatnonzero((width[x] == a) & (width[y] == b))
                    for k in range(0, len(at), 1 << 15):
                        some = at[k : k + (1 << 15)]
                        differ = _fold(stacked[a][slot[x[some]]], min(a, b)) ^ _fold(stacked[b][slot[y[some]]], min(a, b))
                        slack[some] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) - most[some]
                        keep[some] = slack[some] <= 0
            if keep.any():
                x, y = np.minimum(x[keep], y[keep]), np.maximum(x[keep], y[keep])
                weight = np.ones(len(x), dtype=np.int64)
                if nearest:
                    low, high = np.minimum(group_of[x], group_of[y]), np.maximum(group_of[x], group_of[y])
                    order = np.lexsort((slack[keep], high, low))
                    x, y, low, high = x[order], y[order], low[order], high[order]
                    new = np.ones(len(order), dtype=bool)
                    new[1:] = (np.diff(low) != 0) | (np.diff(high) != 0)
                    at = np.flatnonzero(new)
                    lead = np.repeat(at, np.diff(np.append(at, len(x))))
                    weight = np.add.reduceat(((x != x[lead]) | (y != y[lead])).astype(np.int64), at)  # other pairs left out
                    x, y = x[at], y[at]
                found.append((x, y, weight))

        def counted() -> None:
            if found:
                x, y, times = (np.concatenate(c) for c in zip(*found))
                pair, where = np.unique(x * len(classes) + y, return_inverse=True)
                found[:] = [(pair // len(classes), pair % len(classes), np.bincount(where, weights=times).astype(np.int64))]

        def held() -> int:
            return sum(len(x) for x, _, _ in found)

        def out() -> pa.RecordBatch:
            x, y, times = found[0]
            found.clear()
            if nearest:
                pairs_of = np.stack([np.minimum(group_of[x], group_of[y]), np.maximum(group_of[x], group_of[y])], axis=1)
                _, one_of, which, pairs = np.unique(pairs_of, axis=0, return_index=True, return_inverse=True, return_counts=True)
                times = np.bincount(which.ravel(), weights=times).astype(np.int64) + pairs - 1
                x, y = x[one_of], y[one_of]
            a, b = classes[x], classes[y]
            least = np.zeros(len(x), dtype=np.int64) if nearest else np.minimum(_shares(n[one][x]), _shares(n[one][y]))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(times), pa.array(least)], names=["a", "b", "times", "least"])

        order = np.lexsort((root, deal, band, tile))
        edge = np.concatenate([[0], np.flatnonzero((np.diff(tile[order]) != 0) | (np.diff(band[order]) != 0) | (np.diff(deal[order]) != 0)) + 1, [len(order)]])
        count = np.diff(edge)
        group = np.repeat(np.arange(len(count)), count)
        small = np.flatnonzero((count <= SMALL_GROUP)[group])
        for step in range(1, SMALL_GROUP):
            same = np.flatnonzero(group[small[:-step]] == group[small[step:]])
            add(order[small[same]], order[small[same + step]])
        for g in np.flatnonzero(count > SMALL_GROUP):
            rows = order[edge[g] : edge[g + 1]]
            if (root[rows] == root[rows[0]]).all():
                continue
            # Rows are in order of their component: partners of one come before its first row.
            first = np.searchsorted(root[rows], root[rows])
            for low in range(0, len(rows), ROWS_AT_ONCE):
                block, before = rows[low : low + ROWS_AT_ONCE], first[low : low + ROWS_AT_ONCE]
                for start in range(0, before[-1], PARTNERS_AT_ONCE):
                    end = min(start + PARTNERS_AT_ONCE, int(before[-1]))
                    other = rows[start:end]
                    i, j = np.nonzero((np.arange(start, end)[None, :] < before[:, None])
                                      & (100 * n[other][None, :] >= percent * n[block][:, None]) & (100 * n[block][:, None] >= percent * n[other][None, :]))
                    add(block[i], other[j])
                    if held() > PAIRS_HELD or len(found) > 500:
                        counted()
                        if held() > PAIRS_HELD // 2:
                            yield out()
        counted()
        if found:
            yield out()

    # ``times`` counts the shared tiles of a pair or, of a nearest one, the other pairs of its components.
    rows = rows.repartition("tile", "band", "pair").sortWithinPartitions("tile", "band", "pair")
    pairs = rows.mapInArrow(run, "a long, b long, times long, least long")
    pairs = pairs.groupBy("a", "b").agg(F.sum("times").alias("times"), F.first("least").alias("least"))
    return pairs.filter("times >= least").select("a", "b", (F.col("times") > 0).alias("more"))


def _rooted(tiles: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the tiles with the component that each class is known to be in so far."""
    return tiles.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of tiles that hold two components or more, and how many rows the tile has."""
    mixed = rows.groupBy("tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members"))
    return rows.join(mixed.filter("lo <> hi").select("tile", "members"), "tile")


def _open(rows: DataFrame, near: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Rows that all pairs have to be made of once the nearest pairs are checked.

    Where two components had one pair only, that was checked. Left are components that had more and are
    still apart, and sets that may link with one that has no bitmap.
    """
    ends = near.filter("more").select("a", "b")
    for side in ("a", "b"):
        ends = ends.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"of_{side}")), side, "left")
        ends = ends.withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    apart = ends.filter("of_a <> of_b").select(F.explode(F.array("of_a", "of_b")).alias("root")).distinct()
    large = F.col("n").cast("long") * 100 >= percent * LARGE
    apart = apart.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    others = rows.filter(~large).withColumn("part", F.pmod(F.xxhash64("class"), F.lit(PARTS)).cast("int"))
    return rows.filter(large).unionByName(others.join(apart, ["root", "part"], "left_semi").drop("part"))


def _chained(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of neighbours in each tile in order of size and class.

    Rows are dealt by range, so that a common tile is cut into several tasks; neighbours of two tasks make no pair.
    """
    order = ["tile", "n", "class"]
    rows = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [np.zeros(0, dtype=np.int64)] * 3
        for batch in batches:
            tile, n, key = last = [np.concatenate([x[-1:], c.to_numpy().astype(np.int64)]) for x, c in zip(last, batch.columns)]
            near = np.flatnonzero((tile[1:] == tile[:-1]) & (100 * n[:-1] >= percent * n[1:]) & (key[1:] != key[:-1]))
            x, y = key[near], key[near + 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _least_of_root(rows: DataFrame) -> DataFrame:
    """``rows`` (class, root, least) with ``component_id``, the smallest ``least`` of the root.

    A root may have most of the rows, so they meet in ``PARTS`` parts of it.
    """
    rows = rows.withColumn("part", F.pmod(F.xxhash64("class"), F.lit(PARTS)).cast("int"))
    parts = rows.groupBy("root", "part").agg(F.min("least").alias("least"))
    whole = parts.groupBy("root").agg(F.min("least").alias("component_id"), F.collect_list("part").alias("parts"))
    return rows.join(whole.select("root", "component_id", F.explode("parts").alias("part")), ["root", "part"]).drop("part")


def join(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All columns of ``documents`` but the text, ``n_shingles``, ``component_id`` (smallest doc_id linked)
    and ``component`` (a number of each component, also of those that have no id)."""
    release_shuffles(documents.sparkSession)
    documents, restore = shield(documents, ["doc_id", "text"])
    texts = documents.select("text").filter("text is not null")
    others = [c for c in documents.columns if c != "text"]
    placed = write_once(class_of(documents.withColumn("_hash", F.xxhash64("text")))).rows
    # An empty set is a class of its own id, which holds nothing else.
    alone = F.xxhash64(F.lit("empty set"), "doc_id").bitwiseAND(F.lit(-2))
    placed = placed.withColumn("_class", F.coalesce("_class", alone))
    classes = placed.groupBy("_class").agg(F.min("doc_id").alias("_least"), F.first("_n").alias("_n"), F.first("_bits").alias("_bits"), F.min("_hash").alias("_hash"))
    common = _common(texts, placed.count())
    tiled = write_once(_shared(_leading(texts, common, percent)))
    tiles = tiled.rows

    bits = classes.select(F.col("_class").alias("class"), F.col("_n").alias("n"), F.col("_bits").alias("bits"))
    reps = classes.filter("_n > 0").select(F.col("_class").alias("class"), F.col("_hash").alias("hash"))
    near = _bounded(_chained(tiles, percent).distinct(), bits, percent)
    roots = write_once(components(_verified(write_once(near).rows, texts, reps, percent))).rows

    # Components that are left meet at their nearest pairs first, then at all.
    inside = bits.select("class", F.when(F.col("n") <= LARGE, F.col("bits")).alias("bits"))
    rows = _mixed(_rooted(tiles, roots))
    near = write_once(_banded(rows, inside, percent, nearest=True)).rows
    found = _verified(near, texts, reps, percent)
    roots = write_once(components(found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))).rows
    rows = _mixed(_open(_rooted(tiles, roots), near, roots, percent))
    found = _verified(write_once(_banded(rows, inside, percent, nearest=False)).rows, texts, reps, percent)
    tiled.delete()
    every = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))
    linked = classes.select(F.col("_class").alias("class"), F.col("_least").alias("least")).join(every.select(F.col("node").alias("class"), "root"), "class")
    named = write_once(_least_of_root(linked)).rows.select(F.col("class").alias("_class"), F.col("root").alias("_root"), "component_id")
    # Classes without a link are components of their own.
    single = classes.select("_class", "_least").join(named, "_class", "left")
    single = single.select("_class", F.coalesce("_root", "_class").alias("component"), F.when(F.col("_root").isNull(), F.col("_least")).otherwise(F.col("component_id")).alias("component_id"))
    out = placed.join(single, "_class").select(*others, F.col("_n").alias("n_shingles"), "component_id", "component")
    return restore(out, "n_shingles", "component_id", "component")
