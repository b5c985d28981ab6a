"""Phrase collocations by Toivonen's sampling.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line breaks, and those into words at spaces
and tabs. A sample of the documents proposes phrases at a lowered minimum. The full pass counts exactly the
proposed phrases and their negative border: a phrase is counted when it is a single word, or when it less
its last and less its first word are both proposed, whether it was proposed itself or not. A phrase that the
pass finds frequent although the sample did not propose it is a border failure: longer phrases round it may
have been missed. Then an expansion pass counts all phrases that are still open: those not counted yet
whose parts are each known to be frequent or open as well. A frequent phrase is counted by the first pass or open in
the second, so nothing is left after that.

What is proposed or frequent travels as a bit set: a phrase taken for a member by chance is counted too, and none is lost.
These passes count phrases by a 64-bit hash. A last pass over the texts spells the frequent
ones and counts them by their words; only phrases of equal hashes in one group of texts count as one there.

Cases: a null or empty text has no words; a null group is ``und``; repeated rows count each; other columns are
not read, so their names can't clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bitset import maybe_in, wide_bit_set
from millrace.llm.columns import named, release_shuffles
from millrace.llm.text import Spans, chunks, grams, hashes, mix, words
from millrace.session import write_once

#: Bytes that end a word, and those of them that end a piece.
SPLITTERS = b".,;:!?\n\x0b\x0c\r"
BREAKS = b" \t" + SPLITTERS
#: Share of the documents in the sample, and the most bits of a set of phrases as a power of two.
SHARE, SET_BITS = 1 / 8, 27


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[Spans, np.ndarray]:
    """The words of a group of texts, and the number of the first word of every piece (with the end)."""
    w = words(data, offsets, ~_table(BREAKS))
    if not len(w.start):
        return w, np.zeros(1, dtype=np.int64)
    seen = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_table(SPLITTERS)[data], out=seen[1:])
    cut = (seen[w.start[1:]] > seen[w.end[:-1]]) | (w.text[1:] != w.text[:-1])
    return w, np.concatenate([[0], np.flatnonzero(cut) + 1, [len(w.start)]])


def spaced(data: np.ndarray, offsets: np.ndarray, w: Spans) -> tuple[np.ndarray, np.ndarray]:
    """The words lower-cased with one space after each, and where each begins (with the end)."""
    first = np.zeros(len(w.start) + 1, dtype=np.int64)
    np.cumsum(w.end - w.start + 1, out=first[1:])
    # With a space after every text there is a byte after every word, which becomes its space.
    apart = np.insert(_LOWER[data], offsets[1:], 0x20)
    edge = np.zeros(len(apart) + 1, dtype=np.int8)
    edge[w.start + w.text] += 1
    edge[w.end + w.text + 1] -= 1
    out = apart[np.cumsum(edge[:-1], dtype=np.int8) == 1]
    out[first[1:] - 1] = 0x20
    return out, first


def cut_texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges as an array of texts."""
    ends = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(end - start, out=ends[1:])
    at = np.arange(ends[-1]) + np.repeat(start - ends[:-1], end - start)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[at])))


def _windows(documents: DataFrame, group: str, text: str) -> DataFrame:
    return documents.select(F.coalesce(named(group).cast("string"), F.lit("und")).alias("group"), named(text).alias("text"))


def _group_hashes(column: pa.Array) -> np.ndarray:
    """A hash of the group of every row."""
    coded = column.dictionary_encode()
    names = coded.dictionary.cast(pa.large_string())
    found = np.zeros(len(names), dtype=np.uint64)
    for low, high, data, offsets in chunks(names):
        found[low:high] = hashes(data, offsets[:-1], offsets[1:], fold=False)
    # Mixed once more, or word a of group b would look like word b of group a.
    return mix(found)[coded.indices.to_numpy(zero_copy_only=False)]


def propose(documents: DataFrame, key: Column, minimum: int, longest: int, share: float = SHARE) -> DataFrame:
    """Hashes of the phrases of less than ``longest`` words that are frequent in a sample of the rows.

    ``documents`` has the columns group and text; ``key`` decides by its hash whether a row is in the sample.
    The minimum is lowered to 0.7 of what the share leaves of it.
    """
    lowered = max(2, round(0.7 * minimum * share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, first, h in _hashed(batch):
                for size in range(1, longest):
                    found, n = np.unique(grams(h, first, size)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["hash", "n"])

    rows = documents.where(F.pmod(key, F.lit(1 << 20)) < int(share * (1 << 20)))
    found = rows.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= lowered).select("hash")


def _hashed(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Spans, np.ndarray, np.ndarray]]:
    """First and last row, bytes, offsets, words, first words of the pieces and hashes of the words (by group) of groups of texts."""
    of_row = _group_hashes(batch.column(0))
    for low, high, data, offsets in chunks(batch.column(1)):
        w, first = pieces(data, offsets)
        if len(w.start):
            yield low, high, data, offsets, w, first, mix(hashes(data, w.start, w.end, fold=True) ^ of_row[low:high][w.text])


def count(documents: DataFrame, proposed: np.ndarray, frequent: np.ndarray | None, longest: int) -> DataFrame:
    """Counts by hash of phrases: size, hash, n.

    Without ``frequent``: words, proposed phrases and their border. With it, the phrases found frequent by then:
    what was not counted and is open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, first, h in _hashed(batch):
                # By the place of the first word: whether the phrase one word shorter is proposed, and whether it may be frequent.
                inside, likely = np.zeros(len(h) + 1, dtype=bool), np.zeros(len(h) + 1, dtype=bool)
                for size in range(1, longest + 1):
                    found, at = grams(h, first, size)
                    done = inside[at] & inside[at + 1] if size > 1 else np.ones(len(at), dtype=bool)
                    parts = likely[at] & likely[at + 1]
                    wanted = done if frequent is None else ~done & parts
                    inside[:], likely[:] = False, False
                    if size < longest:
                        inside[at] = maybe_in(proposed, found)
                        if frequent is not None:
                            likely[at] = np.where(done, maybe_in(frequent, found), parts)
                    different, n = np.unique(found[wanted], return_counts=True)
                    if len(n):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(n), size, dtype=np.int32)), pa.array(different.view(np.int64)), pa.array(n)], names=["size", "hash", "n"])

    return documents.mapInArrow(run, "size int, hash long, n long").groupBy("hash", "size").agg(F.sum("n").alias("n"))


def failures(frequent: DataFrame, proposed: np.ndarray, longest: int) -> DataFrame:
    """Frequent phrases that longer ones may hold and that were not proposed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(h[~maybe_in(proposed, h)])], names=["hash"])

    return frequent.where(F.col("size") < longest).select("hash").mapInArrow(run, "hash long")


def spell(documents: DataFrame, likely: np.ndarray, longest: int) -> DataFrame:
    """Exact counts by their words of the phrases whose hash may be in a set: group, size, phrase, hash, n.

    The phrase of size 0 counts all words of a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}

        def out(group: pa.Array, size: np.ndarray, phrase: pa.Array, found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            columns = [group.cast(pa.string()), pa.array(size, pa.int32()), phrase.cast(pa.string()), pa.array(found, pa.int64()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["group", "size", "phrase", "hash", "n"])

        for batch in batches:
            for low, high, data, offsets, w, first, h in _hashed(batch):
                groups = batch.column(0).slice(low, high - low).cast(pa.large_string())
                for g, n in zip(groups.to_pylist(), w.per_text.tolist()):
                    totals[g] = totals.get(g, 0) + n
                buffer, begin = spaced(data, offsets, w)
                alive = np.ones(len(h) + 1, dtype=bool)
                for size in range(1, longest + 1):
                    found, at = grams(h, first, size)
                    # What a frequent phrase holds is frequent too, which leaves few that are in the set by chance.
                    wanted = maybe_in(likely, found) & alive[at] & alive[at + 1] if size > 1 else maybe_in(likely, found)
                    alive[:] = False
                    alive[at] = wanted
                    found, at = found[wanted], at[wanted]
                    if not len(found):
                        continue
                    different, one, n = np.unique(found, return_index=True, return_counts=True)
                    at = at[one]
                    yield out(groups.take(pa.array(w.text[at])), np.full(len(at), size), cut_texts(buffer, begin[at], begin[at + size] - 1), different.view(np.int64), n)
        if totals:
            none = np.zeros(len(totals), dtype=np.int64)
            yield out(pa.array(list(totals)), none, pa.array([""] * len(totals)), none, np.array(list(totals.values())))

    found = documents.mapInArrow(run, "group string, size int, phrase string, hash long, n long")
    return found.groupBy("group", "size", "phrase").agg(F.sum("n").alias("n"), F.max("hash").alias("hash"))


@dataclass(frozen=True)
class Mined:
    """Frequent phrases (group, size, phrase, hash, n), all words of a group (group, n), and the passes it took."""

    phrases: DataFrame
    totals: DataFrame
    passes: int


def mine(
    documents: DataFrame, group: str = "lang", text: str = "text", key: str | None = "doc_id", minimum: int = 30, longest: int = 4,
    share: float = SHARE, set_bits: int = SET_BITS,
) -> Mined:
    """All phrases of up to ``longest`` words that occur ``minimum`` times or more in their group, with exact counts.

    ``key`` names the column that, with the text, decides which rows are in the sample; it has no effect on the result.
    """
    release_shuffles(documents.sparkSession)
    rows = _windows(documents, group, text)
    drawn = F.xxhash64(*(named(c) for c in ([key] if key else [])), named(text))
    sample = documents.select(F.coalesce(named(group).cast("string"), F.lit("und")).alias("group"), named(text).alias("text"), drawn.alias("drawn"))
    proposed = wide_bit_set(write_once(propose(sample, F.col("drawn"), minimum, longest, share)).rows, "hash", most=set_bits)
    # A pass writes what it found frequent, and nothing else of what it counted.
    frequent = write_once(count(rows, proposed, None, longest).where(F.col("n") >= minimum)).rows
    known, passes = wide_bit_set(frequent.where(F.col("size") < longest), "hash", most=set_bits), 1
    if not failures(frequent, proposed, longest).isEmpty():
        open_ones = write_once(count(rows, proposed, known, longest).where(F.col("n") >= minimum)).rows
        frequent, passes = frequent.unionByName(open_ones), 2
    likely = wide_bit_set(frequent, "hash", most=set_bits)
    spelled = spell(rows, likely, longest).where((F.col("size") == 0) | (F.col("n") >= minimum))
    written = write_once(spelled).rows
    return Mined(written.where("size > 0"), written.where("size = 0").select("group", "n"), passes)


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def score_cuts(phrases: DataFrame) -> DataFrame:
    """The cut of the lowest score of every phrase of two words or more: group, size, phrase, a, l, r, score."""
    parts = F.split("phrase", " ", -1)
    joined = lambda first, n: F.array_join(F.slice("parts", first, n), " ")
    several = phrases.where("size >= 2").select("group", "size", "phrase", F.col("n").alias("a"), parts.alias("parts"))
    cuts = several.select("group", "size", "phrase", "a", "parts", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "group", "size", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    left = phrases.select("group", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = phrases.select("group", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(left, ["group", "left"]).join(right, ["group", "right"])
    # Products of long integers may pass 64 bits; decimals divide exactly.
    score = F.expr("cast(2000000 * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    scored = both.withColumn("score", score)
    lowest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    best = scored.groupBy("group", "phrase").agg(F.first("size").alias("size"), F.first("a").alias("a"), lowest)
    return best.select("group", "size", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(phrases: DataFrame, percent: int) -> DataFrame:
    """Phrases (group, phrase, longer) that lie in a longer one, with the highest count of one by a word longer.

    Longer ones than that need no look: what holds a phrase and two words more also holds it and one of
    these words, at least as often.
    """
    parts = F.split("phrase", " ", -1)
    inner = F.array(F.array_join(F.slice("parts", F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice("parts", F.lit(2), F.col("size") - 1), " "))
    longer = phrases.where("size >= 3").select("group", "size", "n", parts.alias("parts")).select("group", F.explode(inner).alias("phrase"), "n")
    return longer.groupBy("group", "phrase").agg(F.max("n").alias("longer"))


def collocations(documents: DataFrame, top: int = 2000, cover: int = 80, buckets: int = 64, **options) -> DataFrame:
    """The first ``top`` phrases of every group: group, rank, phrase, a, l, r, n, score.

    A phrase of two words or more is scored by its weakest cut, ``2000000 * a // (l + r)``. Phrases that occur
    ``cover`` percent of the time or more within a longer frequent one are left out. ``options`` go to ``mine``.
    The ranking takes the first of every bucket of a group before it brings a group together.
    """
    mined = mine(documents, **options)
    scored = score_cuts(mined.phrases)
    inside = covered(mined.phrases, cover)
    kept = scored.join(inside, ["group", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * _exact("longer") < F.lit(cover) * _exact("a"))).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    first = kept.withColumn("rank", F.row_number().over(Window.partitionBy("group", "bucket").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*order))).where(F.col("rank") <= top)
    out = ranked.join(mined.totals, "group")
    return out.select("group", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
