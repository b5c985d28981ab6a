"""Suffix-array deduplication with run-length indexes: marks every byte of long strings that occur elsewhere.

A string of ``LENGTH`` bytes that starts at two places or more, in any texts, is a repeat; all bytes of all
its occurrences are removed. Finding them takes three steps, whose data are spread by hash:

1. Texts that are equal are one class; of classes with two texts or more everything is removed (if they
   are long enough), and one text stands for all.
2. Every window of ``LENGTH`` bytes is tied to the smallest hash of its ``GRAM``-byte grams, its anchor. Equal
   windows have equal anchors, so only anchors that occur twice go on. The windows of one anchor lie in one
   stretch of text, its context; equal contexts are repeats as a whole.
3. Contexts of one anchor that differ are put into an index: their run-compressed Burrows-Wheeler transform,
   with the suffix positions at the run ends. Match lengths are computed at the ends of runs and streamed
   along the text from there, which gives the longest match of every position; windows that match in full
   are repeats. Windows of an anchor whose contexts don't fit one index are counted by their hash instead.

Cases: a null or empty text, and one shorter than ``LENGTH``, loses nothing and matches nothing. Repeated
rows and equal texts lose all bytes if long enough. Strings never reach over the end of a text. Rows with
null or equal ids are handled one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T
from millrace.llm.bitset import bit_set, maybe_in
from millrace.llm.columns import release_shuffles, shield
from millrace.session import write_once

LENGTH, GRAM = 200, 64
#: Contexts of so many bytes at most share an index.
INDEX_BYTES = 1 << 20


def _class_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return T.hashes(data, offsets[:-1], offsets[1:], fold=False)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for each i that has so many."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchors of all windows: text, first window, last window, anchor's place (bytes of the group) and hash, context hash."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    place = np.arange(len(data) - gram + 1)
    h = T.hashes(data, place, place + gram, fold=False)
    low = np.uint64((1 << len(data).bit_length()) - 1)
    least = _sliding_min((h & ~low) | place.astype(np.uint64), length - gram + 1)
    at = (least & low).astype(np.int64)
    # Windows that lie within a text.
    start = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(offsets[:-1], offsets[1:]) if b - a >= length] or [none])
    if not len(start):
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    mine = at[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (mine[1:] != mine[:-1]) | (start[1:] != start[:-1] + 1)
    first = start[new]
    last = start[np.append(np.flatnonzero(new)[1:], len(start)) - 1]
    mine = mine[new]
    text = np.searchsorted(offsets, first, side="right") - 1
    context = T.mix(T.hashes(data, first, last + length, fold=False) + (mine - first).astype(np.uint64))
    return text, first, last, mine, h[mine], context


def _occurrences(texts: DataFrame, length: int) -> DataFrame:
    """anchor, ctx, class, lo (first window), n (windows) of the anchors of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in T.chunks(batch.column(0)):
                key = _class_of(data, offsets)
                new = np.array([k not in seen and not seen.add(k) for k in key.tolist()], dtype=bool)
                text, first, last, _, hashed, context = anchors(data, offsets, length)
                keep = new[text]
                text, first, last, hashed, context = (x[keep] for x in (text, first, last, hashed, context))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashed.view(np.int64)), pa.array(context.view(np.int64)), pa.array(key[text].view(np.int64)),
                     pa.array((first - offsets[text]) * 256 + (last - first + 1))],
                    names=["anchor", "ctx", "class", "at"])

    return texts.mapInArrow(run, "anchor long, ctx long, class long, at long")


def _several(*columns: str) -> Column:
    """Whether the rows of a group differ in one of the columns."""
    return reduce(or_, (F.min(c) != F.max(c) for c in columns))


def _repeated(rows: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Occurrences of contexts that occur twice or more, and one of each context of an anchor whose contexts differ.

    Of the second, ``whole`` says that the context occurs twice and ``hot`` that those of its anchor may not fit an
    index. Groups are counted where their rows are, so no task holds all rows of an anchor; a class that two tasks
    have read is the same occurrence twice, which ``_several`` doesn't count. Counts are written before they are
    joined: only a join right after its shuffles is split where it is skewed.
    """
    twice = write_once(rows.groupBy("anchor").agg(_several("ctx", "class", "at").alias("twice")).filter("twice").select("anchor")).rows
    rows = write_once(rows.join(twice, "anchor", "left_semi")).rows
    contexts = write_once(rows.groupBy("anchor", "ctx").agg(
        F.min("class").alias("class"), F.min_by("at", "class").alias("at"), _several("class", "at").alias("whole"))).rows
    whole = rows.join(contexts.filter("whole").select("anchor", "ctx"), ["anchor", "ctx"], "left_semi")
    mixed = write_once(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")).rows
    hot = F.col("n") * (2 * length - gram) > INDEX_BYTES
    return whole, contexts.join(mixed, "anchor").select("anchor", "class", "at", "whole", hot.alias("hot"))


def _texts_of(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """class and its text for the wanted classes, each once."""
    members = bit_set(classes, "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for low, high, data, offsets in T.chunks(batch.column(0)):
                key = _class_of(data, offsets)
                rows = [i for i in np.flatnonzero(maybe_in(members, key)) if int(key[i]) not in seen and not seen.add(int(key[i]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[rows].view(np.int64)), pa.array([data[offsets[i] : offsets[i + 1]].tobytes() for i in rows], pa.binary())],
                    names=["class", "bytes"])

    return texts.mapInArrow(run, "class long, bytes binary").groupBy("class").agg(F.first("bytes").alias("bytes"))


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the last code must be there once."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    n, span = len(codes), 1
    while True:
        key = rank * (n + 1)
        key[:-span] += rank[span:] + 1
        order = np.argsort(key, kind="stable")
        step = np.ones(n, dtype=np.int64)
        step[0] = 0
        step[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n - 1:
            return order
        span *= 2


def long_matches(parts: list[bytes], length: int) -> np.ndarray:
    """For each byte of the concatenated parts: whether ``length`` bytes from there also start elsewhere.

    The parts, each closed by a code of its own, are put into a run-compressed Burrows-Wheeler transform.
    Where two neighbouring rows of it have the same code, their match is the match of the positions before,
    one shorter. So matches are compared byte by byte only where a run begins, at the sampled run ends, and
    streamed along the text from there.
    """
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    size = np.array([len(p) for p in parts])
    # Codes of the text: bytes above all closing codes.
    close = np.cumsum(size + 1) - 1
    codes = np.empty(len(data) + len(parts), dtype=np.int64)
    inside = np.ones(len(codes), dtype=bool)
    inside[close] = False
    codes[inside] = data.astype(np.int64) + len(parts)
    codes[close] = np.arange(len(parts))
    order = suffix_order(codes)
    n = len(codes)
    transform = codes[order - 1]
    head = np.ones(n, dtype=bool)
    head[1:] = transform[1:] != transform[:-1]
    # Sampled run ends: the suffix where a run begins and the one at the end of the run above.
    rows = np.flatnonzero(head)[1:]
    here, above = order[rows], order[rows - 1]
    match = np.zeros(len(rows), dtype=np.int64)
    going = np.arange(len(rows))
    while len(going):
        a, b = here[going] + match[going], above[going] + match[going]
        going = going[codes[a] == codes[b]]
        match[going] += 1
    # Stream: the nearest sampled position at or before each position gives its match with the row above.
    sample = np.full(n, -1, dtype=np.int64)
    sample[here] = here + match
    nearest = np.maximum.accumulate(np.where(sample >= 0, np.arange(n), -1))
    with_above = np.where(nearest >= 0, sample[nearest] - np.arange(n), 0)
    by_row = with_above[order] >= length
    by_row[0] = False
    long_ = np.zeros(n, dtype=bool)
    long_[order] = by_row
    long_[order[:-1]] |= by_row[1:]
    return long_[inside]


def _with_text(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """class, its text, and the occurrences asked for (anchor, at, whole)."""
    wanted = asked.groupBy("class").agg(F.collect_list(F.struct("anchor", "at", "whole")).alias("asked"))
    return _texts_of(texts, asked).join(wanted, "class").select("class", "bytes", "asked")


def _hot_matched(with_text: DataFrame, length: int) -> DataFrame:
    """class, first and last window of the repeats among contexts of anchors that have too many for an index.

    Their windows are counted one by one, by hash: equal ones meet, and others of the anchor are spread.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.uint8)
                rows = batch.column(2)[i].as_py()
                at = np.array([r["at"] for r in rows], dtype=np.int64)
                first, n = at >> 8, at & 255
                lo = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([r["anchor"] for r in rows], dtype=np.int64), n)),
                     pa.array(T.hashes(data, lo, lo + length, fold=False).view(np.int64)),
                     pa.array(np.full(len(lo), batch.column(0)[i].as_py(), dtype=np.int64)), pa.array(lo),
                     pa.array(np.repeat(np.array([r["whole"] for r in rows], dtype=bool), n))],
                    names=["anchor", "window", "class", "lo", "whole"])

    every = write_once(with_text.mapInArrow(windows, "anchor long, window long, class long, lo long, whole boolean")).rows
    again = every.groupBy("anchor", "window").agg(_several("class", "lo").alias("again")).filter("again")
    again = write_once(again.select("anchor", "window")).rows
    return every.filter("not whole").join(again, ["anchor", "window"], "left_semi").select("class", "lo", F.col("lo").alias("hi"))


def _matched(contexts: DataFrame, length: int) -> DataFrame:
    """class, first and last window of the repeats among contexts that differ (anchor, class, lo, whole, context)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        table = table.take(pa.array(np.argsort(table.column(0).to_numpy(), kind="stable")))
        anchor, key, lo, whole = (table.column(i).to_numpy() for i in range(4))
        context = table.column(4).combine_chunks()
        size = np.diff(np.frombuffer(context.buffers()[1], dtype=np.int32)[context.offset : context.offset + len(context) + 1])
        edge = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1, [len(anchor)]])
        weight = np.concatenate([[0], np.cumsum(size)])
        g = 0
        while g < len(edge) - 1:
            # Whole anchors, as many as fill an index.
            last = int(np.searchsorted(weight[edge], weight[edge[g]] + INDEX_BYTES, side="right")) - 1
            rows = np.arange(edge[g], edge[last])
            long_ = long_matches([context[int(i)].as_py() for i in rows], length)
            begin = weight[rows] - weight[rows[0]]
            step = np.diff(np.concatenate([[0], long_.astype(np.int8), [0]]))
            start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1
            # A run of long matches ends before its context does, as the last bytes of a context have none.
            of = np.searchsorted(begin, start, side="right") - 1
            keep = ~whole[rows[of]]
            of, start, end = of[keep], start[keep], end[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[rows[of]]), pa.array(lo[rows[of]] + start - begin[of]), pa.array(lo[rows[of]] + end - begin[of])], names=["class", "lo", "hi"])
            g = last

    return contexts.repartition("anchor").mapInArrow(run, "class long, lo long, hi long")


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def remove(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """All columns of ``documents`` but the text, n_bytes, ``removed`` (array of runs start, end) and kept_sha256."""
    release_shuffles(documents.sparkSession)
    documents, restore = shield(documents, ["text"])
    texts = documents.select("text").filter(F.octet_length("text") >= length)

    every = write_once(_occurrences(texts, length))
    whole, asked = _repeated(every.rows, length, GRAM)
    asked = write_once(asked).rows
    every.delete()
    lo, n = F.shiftright("at", 8), F.col("at") % 256
    whole = whole.select("class", lo.alias("lo"), (lo + n - 1).alias("hi"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_py()
                rows = batch.column(2)[i].as_py()
                first = [r["at"] >> 8 for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["anchor"] for r in rows], pa.int64()), pa.array([batch.column(0)[i].as_py()] * len(rows), pa.int64()), pa.array(first, pa.int64()),
                     pa.array([r["whole"] for r in rows], pa.bool_()), pa.array([data[a : a + r["at"] % 256 - 1 + length] for a, r in zip(first, rows)], pa.binary())],
                    names=["anchor", "class", "lo", "whole", "context"])

    contexts = _with_text(texts, asked.filter("not hot")).mapInArrow(cut, "anchor long, class long, lo long, whole boolean, context binary")
    part = write_once(_matched(contexts, length)).rows
    hot = asked.filter("hot")
    if not hot.isEmpty():
        part = part.unionByName(_hot_matched(_with_text(texts, hot), length))
    spans = whole.unionByName(part).groupBy("class").agg(F.collect_set(F.struct("lo", (F.col("hi") + length).alias("hi"))).alias("spans"))
    spans = write_once(spans).rows
    members = bit_set(spans, "class")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for low, high, data, offsets in T.chunks(batch.column(at)):
                key, size = _class_of(data, offsets), np.diff(offsets)
                likely = maybe_in(members, key) & (size >= length)
                own = [data[offsets[i] : offsets[i + 1]] for i in range(high - low)]
                part_ = batch.slice(low, high - low)
                names = [c for c in part_.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part_.column(part_.schema.get_field_index(c)) for c in names), pa.array(key.view(np.int64)), pa.array(size, pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in own]), pa.array([x.tobytes() if y else None for x, y in zip(own, likely)], pa.binary())],
                    names=[*names, "class", "n_bytes", "sha256", "bytes"])

    others = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name != "text"]
    names = [c for c in documents.columns if c != "text"]
    rows = documents.mapInArrow(read, ", ".join([*others, "class long, n_bytes long, sha256 string, bytes binary"]))

    def key_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in T.chunks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(_class_of(data, offsets).view(np.int64))], names=["class"])

    copies = texts.mapInArrow(key_only, "class long").groupBy("class").count().filter("count > 1").select("class", F.lit(True).alias("copied"))
    marks = spans.join(copies, "class", "full_outer")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            removed, sha = [], column["sha256"].to_pylist()
            copied, all_spans, size = column["copied"].to_pylist(), column["spans"], column["n_bytes"].to_pylist()
            for i in range(batch.num_rows):
                runs: list[list[int]] = []
                if copied[i]:
                    runs, sha[i] = [[0, size[i]]], hashlib.sha256(b"").hexdigest()
                elif all_spans[i].is_valid:
                    runs = _merged([(s["lo"], s["hi"]) for s in all_spans[i].as_py()])
                    data, kept, done = column["bytes"][i].as_buffer(), hashlib.sha256(), 0
                    for a, b in runs:
                        kept.update(memoryview(data)[done:a])
                        done = b
                    kept.update(memoryview(data)[done:])
                    sha[i] = kept.hexdigest()
                removed.append([{"start": a, "end": b} for a, b in runs])
            runs = pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*(column[c] for c in names), column["n_bytes"], runs, pa.array(sha, pa.string())], names=[*names, "n_bytes", "removed", "kept_sha256"])

    joined = rows.join(marks, "class", "left").select(*names, "n_bytes", "sha256", F.when(F.col("copied").isNull(), F.col("bytes")).alias("bytes"),
                                                      F.when(F.col("copied").isNull(), F.col("spans")).alias("spans"), "copied")
    out = joined.mapInArrow(finish, ", ".join([*others, "n_bytes long, removed array<struct<start:bigint,end:bigint>>, kept_sha256 string"]))
    return restore(out, "n_bytes", "removed", "kept_sha256")
