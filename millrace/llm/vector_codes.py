"""Vector codes by a product quantiser whose parts are walked as a trie.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts. The parts of a position are
coded by the nearest entry of the position's codebook. Equal parts are counted once, and a partition of
different parts in lexicographic order is a trie: parts that begin with the same components share a path.
The walk goes down the trie depth first and keeps, for the node it stands on, the distances of the path so
far to every entry; a child adds its own component to its parent's distances. A leaf takes the nearest
entry and adds its part, times its count, to the sum of that entry. Leaves are walked in blocks,
all nodes of a block and a depth in one numpy step, which bounds the memory by the block.

All sums are integers, so a result does not depend on partitioning. One round of the fit is one pass over the
counted parts; what reaches the driver is one number per component of a codebook.

Cases: a vector that is null, or that holds a null, a NaN or an infinity is left out. A vector that is not as long as the
one of the smallest id, or whose length does not divide into the parts, is in no codebook; its code and error are
null. Codebooks begin with the vectors of the smallest different ids, of equal ids with the smallest vector;
null ids come last and begin none. Fewer different ids make fewer entries. Repeated rows count each. A component
whose integer is beyond ``LARGEST`` is an error, as squares of it would not fit long integers. Other
columns stay as they are. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import named, release_shuffles, shield
from millrace.session import write_once

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 27
#: Leaves of the trie that are walked at once.
BLOCK = 1 << 13


def walk(leaves: np.ndarray, codebook: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every leaf (ties to the lower one) and its squared distance; sorted leaves share most of their paths."""
    n, depth = leaves.shape
    nearest, error = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    path: list[np.ndarray] = []  # distances of the nodes on the way to the last leaf, by depth
    for low in range(0, n, block):
        part = leaves[low : low + block]
        # Depth at which a leaf leaves the path of the one before it: the number of leading components they share.
        before = leaves[low - 1] if low else None
        shared = np.zeros(len(part), dtype=np.int64)
        if len(part) > 1:
            same = np.logical_and.accumulate(part[1:] == part[:-1], axis=1)
            shared[1:] = same.sum(axis=1)
        if before is not None:
            shared[0] = int(np.logical_and.accumulate(part[0] == before).sum())
        node_of = np.zeros(len(part), dtype=np.int64)
        at_parents = np.zeros((1, len(codebook)), dtype=np.int64)
        last = []
        for d in range(depth):
            opens = shared <= d  # the first leaf below every node of this depth
            kept = not opens[0]  # the block goes on below the node where the one before it ended
            opens[0] = True
            first = np.flatnonzero(opens)
            step = part[first, d][:, None] - codebook[:, d][None, :]
            here = at_parents[node_of[first]] + step * step
            if kept:
                here[0] = path[d]
            node_of, at_parents = np.cumsum(opens) - 1, here
            last.append(here[-1])
        path = last
        chosen = at_parents.argmin(axis=1)
        nearest[low : low + block] = chosen[node_of]
        error[low : low + block] = at_parents[node_of, chosen[node_of]]
    return nearest, error


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def quantise(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


@dataclass(frozen=True)
class Codebooks:
    """Final entries by position: ``parts`` matrices of (entries, components of a part)."""

    books: list[np.ndarray]
    length: int

    def sha256(self) -> str:
        """Of all components by part, entry and place, in decimal with commas."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def _first_entries(vectors: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    ids = [r["id"] for r in vectors.where("id is not null").select("id").distinct().orderBy("id").limit(entries).collect()]
    first = vectors.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("vector").alias("vector"))
    seeds = [r["vector"] for r in first.orderBy("id").collect()]
    if not seeds or not seeds[0] or len(seeds[0]) % parts:
        return []
    seeds = [s for s in seeds if len(s) == len(seeds[0])]
    return list(np.array(seeds, dtype=np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2))


def _round(counted: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Entries replaced by the mean (rounded down) of their parts; an unused entry stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), b.shape[1] + 1), dtype=object) for b in books]
        for batch in batches:
            position, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            part = _matrix(batch.column(1))
            # Files are sorted by position, so a batch is a few stretches of one position each.
            borders = [0, *(np.flatnonzero(np.diff(position)) + 1).tolist(), len(position)]
            for low, high in zip(borders, borders[1:]):
                if low == high:
                    continue
                p, leaf, weight = position[low], part[low:high], n[low:high]
                nearest, _ = walk(leaf, books[p])
                order = np.argsort(nearest, kind="stable")
                used, first = np.unique(nearest[order], return_index=True)
                whole = np.concatenate([leaf, np.ones((len(leaf), 1), dtype=np.int64)], axis=1)
                if int(weight.max()) * LARGEST * len(weight) >= 1 << 62:
                    whole, weight = whole.astype(object), weight.astype(object)
                sums[p][used] += np.add.reduceat((whole * weight[:, None])[order], first, axis=0).astype(object)
        for p, total in enumerate(sums):
            rows = np.flatnonzero(total[:, -1] > 0)
            flat = [str(x) for r in rows for x in total[r]]
            width = total.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(flat), p, dtype=np.int32)), pa.array(np.repeat(rows, width).astype(np.int32)),
                 pa.array(np.tile(np.arange(width), len(rows)).astype(np.int32)), pa.array(flat, pa.string())],
                names=["position", "entry", "place", "total"])

    found = counted.select("position", "part", "n").mapInArrow(run, "position int, entry int, place int, total string")
    sums = found.groupBy("position", "entry", "place").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total"))
    totals = [np.zeros((len(b), b.shape[1] + 1), dtype=object) for b in books]
    for r in sums.collect():
        totals[r["position"]][r["entry"], r["place"]] = int(r["total"])
    after = []
    for book, total in zip(books, totals):
        new = book.copy()
        for e in range(len(book)):
            if total[e, -1]:
                new[e] = [x // total[e, -1] for x in total[e, :-1]]
        after.append(new)
    return after


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of integer vectors (id, vector)."""
    books = _first_entries(vectors, parts, entries)
    if not books or not rounds:
        return Codebooks(books, parts * books[0].shape[1] if books else 0)
    width = books[0].shape[1]
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("vector", p * width + 1, width))
    rows = vectors.where(F.size("vector") == parts * width).select(F.posexplode(cut).alias("position", "part"))
    # Equal parts are counted before they are moved, so a vector that fills a third of the table is one row per task.
    counted = rows.groupBy("position", "part").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("position", "part")
    written = write_once(counted.select("position", "part", "n"))
    for _ in range(rounds):
        books = _round(written.rows, books)
    written.delete()
    return Codebooks(books, parts * width)


def _coded(vectors: DataFrame, books: Codebooks, parts: int) -> DataFrame:
    """Every row with its code and error in place of its vector."""
    length, final = books.length, books.books
    names = [c for c in vectors.columns if c != "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column(batch.schema.get_field_index("vector"))
            sizes = vector.value_lengths().to_numpy(zero_copy_only=False)
            fits = np.flatnonzero(sizes == length) if final else np.zeros(0, dtype=np.int64)
            error = np.zeros(len(fits), dtype=np.int64)
            codes = np.zeros((len(fits), parts), dtype=np.int64)
            if len(fits):
                whole = _matrix(vector.take(pa.array(fits))).reshape(len(fits), parts, -1)
                for p in range(parts):
                    leaves, of_leaf = np.unique(whole[:, p], axis=0, return_inverse=True)
                    nearest, off = walk(leaves, final[p])
                    codes[:, p] = nearest[of_leaf.ravel()]
                    error += off[of_leaf.ravel()]
            texts = np.full(batch.num_rows, None, dtype=object)
            texts[fits] = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            errors = np.full(batch.num_rows, None, dtype=object)
            errors[fits] = error.tolist()
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(errors, pa.int64())], names=[*names, "code", "error"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema if f.name != "vector"]
    return vectors.mapInArrow(run, ", ".join([*fields, "code string, error bigint"]))


def compress(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """The usable rows of ``embeddings`` with code, error, label_error and codebooks_sha256 instead of the vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook holds 1 to 256 entries, as a code has two hex digits")
    release_shuffles(embeddings.sparkSession)
    used = list(dict.fromkeys([key, vector, label]))
    inner, restore = shield(embeddings, used)
    whole = quantise(named(vector), scale)
    beyond = F.exists(whole, lambda x: F.abs(x) > LARGEST)
    whole = F.when(beyond, F.raise_error(F.lit("a component is too large for squares in long integers")).cast("array<bigint>")).otherwise(whole)
    rows = inner.where(usable(named(vector)))
    books = fit(rows.select(named(key).alias("id"), whole.alias("vector")), parts, entries, rounds)
    # The vector moves to a name of the operator's own; the caller's columns can't have it.
    kept = [named(c).alias(f"own_{i}") for i, c in enumerate(inner.columns) if c != vector]
    coded = write_once(_coded(rows.select(*kept, whole.alias("vector")), books, parts)).rows
    back = [F.col(f"own_{i}").alias(c) for i, c in enumerate(inner.columns) if c != vector]
    coded = coded.select(*back, "code", "error")
    # Sums per label are small beside the rows; a label of a third of all rows is one row here.
    sums = coded.groupBy(named(label).alias("of_label")).agg(F.sum("error").alias("label_error"))
    out = coded.join(sums, named(label).eqNullSafe(F.col("of_label")), "left").withColumn("codebooks_sha256", F.lit(books.sha256()))
    return restore(out, "code", "error", "label_error", "codebooks_sha256")
