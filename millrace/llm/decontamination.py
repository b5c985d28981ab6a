"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. Of every window
of ``window`` words the smallest hash of its ``gram``-word grams is the window's fingerprint, so two texts
that share ``window`` words in a row share a fingerprint. Fingerprints of the test items travel to the
documents as a bit set of fixed size; windows round a fingerprint that may match are joined with the items'
windows, and the words of all joined windows are the extended hits.

Cases: a null or empty text has no words and no hits. A document row is judged by itself, also when its id
is null or repeated. An item of fewer than ``window`` words, but not none, is one window of its own length.
Items without words, and null items, are in no document; item rows with one id count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T
from millrace.llm.columns import shield
from millrace.session import write_once

WINDOW, GRAM = 10, 5
#: Bits of the set of the items' fingerprints; a fuller set lets more windows through to the join.
SET_BITS = 22


def _windows(w: T.Spans, h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and fingerprint of each window of ``window`` words."""
    whole, at = T.grams(h, w.first, window)
    if not len(at):
        return whole, at, whole
    small, small_at = T.grams(h, w.first, gram)
    by_word = np.zeros(len(h), dtype=np.uint64)
    by_word[small_at] = small
    least = by_word[at]
    for i in range(1, window - gram + 1):
        np.minimum(least, by_word[at + i], out=least)
    return whole, at, least


def _bits(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SET_BITS)).astype(np.int64)


def item_windows(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Windows of the test items: item_id, words, hash, bit of the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in T.chunks(batch.column(1)):
                w = T.words(data, offsets, T.ALPHANUMERIC)
                h = T.hashes(data, w.start, w.end, fold=True)
                whole, at, least = _windows(w, h, window, gram)
                found = [(w.text[at], np.full(len(at), window), whole, _bits(least))]
                n = w.per_text
                for size in range(1, window):
                    rows = np.flatnonzero(n == size)
                    if len(rows):
                        one, one_at = T.grams(h, w.first, size)
                        one = one[np.searchsorted(one_at, w.first[rows])]
                        found.append((rows, np.full(len(rows), size), one, _bits(one)))
                text, words, whole, bit = (np.concatenate(x) for x in zip(*found))
                ids = batch.column(0).slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(text)), pa.array(words, pa.int32()), pa.array(whole.view(np.int64)), pa.array(bit, pa.int32())],
                    names=["item_id", "words", "hash", "bit"],
                )

    rows = benchmark.select(F.col("item_id"), F.col("text")).filter("item_id is not null")
    item = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item_id {item}, words int, hash long, bit int").distinct()


def _bit_set(windows: DataFrame) -> np.ndarray:
    """The items' fingerprints as a bit set: at most ``2 ** SET_BITS / 64`` numbers come to the driver."""
    words = windows.groupBy((F.col("bit") / 64).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("bits")).collect()
    out = np.zeros(1 << (SET_BITS - 6), dtype=np.int64)
    for row in words:
        out[row.at] = row.bits
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def _scan(documents: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    """All columns of ``documents`` but the text, ``_n_words``, and ``_windows``: those whose fingerprint an item may have."""
    members = np.packbits(_bit_set(items), bitorder="little")
    lengths = sorted(r.words for r in items.select("words").filter(F.col("words") < window).distinct().collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(members, bitorder="little").view(bool)
        for batch in batches:
            for low, high, data, offsets in T.chunks(batch.column(batch.schema.get_field_index("text"))):
                w = T.words(data, offsets, T.ALPHANUMERIC)
                h = T.hashes(data, w.start, w.end, fold=True)
                whole, at, least = _windows(w, h, window, gram)
                likely = known[_bits(least)]
                found = [(at[likely], np.full(int(likely.sum()), window), whole[likely])]
                for size in lengths:
                    one, one_at = T.grams(h, w.first, size)
                    likely = known[_bits(one)]
                    found.append((one_at[likely], np.full(int(likely.sum()), size), one[likely]))
                word, size, hashed = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(w.text[word], kind="stable")
                word, size, hashed = word[order], size[order], hashed[order]
                ends = np.searchsorted(w.text[word], np.arange(high - low + 1)).astype(np.int32)
                windows = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                    [pa.array(word - w.first[w.text[word]] if len(word) else word, pa.int64()), pa.array(size, pa.int32()), pa.array(hashed.view(np.int64))],
                    names=["at", "words", "hash"]))
                part = batch.slice(low, high - low)
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(w.per_text, pa.int64()), windows],
                    names=[*names, "_n_words", "_windows"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name != "text"]
    return documents.mapInArrow(run, ", ".join([*kept, "_n_words bigint", "_windows array<struct<at:bigint,words:int,hash:bigint>>"]))


def judge(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document row: its columns but the text, n_words, n_hit (words inside an occurrence of an
    item's window) and items (the ids of such items, sorted as strings)."""
    documents, restore = shield(documents, ["text"])
    items = write_once(item_windows(benchmark, window, gram)).rows
    scanned = _scan(documents, items, window, gram)
    key = [c for c in documents.columns if c != "text"]
    rows = scanned.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.select("_row", *key, "_n_words", F.explode_outer("_windows").alias("_w"))
    # A row without a window gets a join key of its own, so that such rows are spread over all tasks.
    rows = rows.select("_row", *key, "_n_words", F.col("_w.at").alias("_at"), F.col("_w.words").alias("_words"),
                       F.coalesce("_w.hash", F.xxhash64("_row")).alias("_hash"))
    found = items.select(F.col("item_id").alias("_item"), F.col("hash").alias("_hash"), F.col("words").alias("_of"))
    joined = rows.join(found, (rows["_hash"] == found["_hash"]) & (rows["_words"] == found["_of"]), "left")
    span = F.when(F.col("_item").isNotNull(), F.struct(F.col("_at").alias("a"), (F.col("_at") + F.col("_words")).alias("b")))
    out = joined.groupBy("_row").agg(
        *(F.first(c).alias(c) for c in [*key, "_n_words"]),
        F.sort_array(F.collect_set(span)).alias("_spans"),
        F.sort_array(F.collect_set(F.col("_item").cast("string"))).alias("items"))
    covered = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"),
                                F.greatest(s["b"], acc["end"]).alias("end")),
        lambda acc: acc["n"])
    return restore(out.select(*key, F.col("_n_words").alias("n_words"), covered.alias("n_hit"), "items"), "n_words", "n_hit", "items")
