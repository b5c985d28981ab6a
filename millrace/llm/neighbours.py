"""Quality classifier by nearest neighbours among labelled latent-semantic vectors.

Terms are hashed byte trigrams of the whole text and binned shape terms (distinct, upper-case, mark and
symbol shares). ``fit`` weighs them by inverse document frequency on a bounded sample of labelled
documents, takes the leading directions of their matrix (latent semantic analysis) and keeps the sample's
vectors. ``score`` projects every document, computes its cosine with every kept vector, a block of
documents at a time, and lets the ``K`` nearest vote with weights that grow with similarity.

Cases: a null or empty text has no terms; its score is the smoothed share of label 1 among the sample's
empty texts and, as a prior, all its texts. Rows are scored one by one, so copies score alike. Without
labelled documents every score is 0.5. Equal similarities are ordered by the sample's fixed order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T
from millrace.llm.columns import shield

#: Labelled documents that are kept, buckets of trigrams, directions and neighbours.
FIT_DOCUMENTS, BUCKETS, DIRECTIONS, K = 3000, 2048, 64, 25
SHARPNESS = 4.0
THRESHOLD = 0.3
_BINS = 10
_SHAPES = 5
_ROWS = 512

_UPPER, _LETTER, _MARK, _SYMBOL = (np.zeros(256, dtype=bool) for _ in range(4))
_UPPER[0x41:0x5B] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK[list(b"!?|")] = True
_SYMBOL[list(b"#*$%&<>=@~^")] = True


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    empty: float


def _bin(share: np.ndarray) -> np.ndarray:
    return np.minimum((np.sqrt(np.clip(share, 0, 1)) * _BINS).astype(np.int64), _BINS - 1)


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term weights (text x term) before inverse document frequency; zeros for an empty text."""
    n, length = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((n, BUCKETS + _SHAPES * _BINS), dtype=np.float32)
    if len(data) >= 3:
        code = (data[:-2].astype(np.uint32) << np.uint32(16)) | (data[1:-1].astype(np.uint32) << np.uint32(8)) | data[2:]
        bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(21)).astype(np.int64) % BUCKETS
        text = np.repeat(np.arange(n), length)
        inside = text[2:] == text[:-2]
        counts = np.bincount(text[:-2][inside] * BUCKETS + bucket[inside], minlength=n * BUCKETS)
        out[:, :BUCKETS] = np.sqrt(counts.reshape(n, BUCKETS))
    norm = np.sqrt((out**2).sum(axis=1, keepdims=True))
    out /= np.maximum(norm, 1)
    w = T.words(data, offsets, T.SPACED)
    n_words = np.maximum(w.per_text, 1)
    h = T.hashes(data, w.start, w.end, fold=True)
    pair, at = T.grams(h, w.first, 3)
    again, _ = T.first_and_repeated(w.text[at], pair)
    letters = np.maximum(T.sums(_LETTER[data], offsets[:-1], offsets[1:]), 1)
    shares = (
        np.bincount(w.text[at], weights=again, minlength=n) / n_words,
        T.sums(_UPPER[data], offsets[:-1], offsets[1:]) / letters,
        T.sums(_MARK[data], offsets[:-1], offsets[1:]) / n_words,
        T.sums(_SYMBOL[data], offsets[:-1], offsets[1:]) / n_words,
        np.log2(1 + w.per_text) / 20.0,
    )
    full = np.flatnonzero(length > 0)
    for i, share in enumerate(shares):
        out[full, BUCKETS + i * _BINS + _bin(share[full])] = 0.35
    return out


def _project(x: np.ndarray, idf: np.ndarray, directions: np.ndarray) -> np.ndarray:
    v = (x * idf) @ directions
    return v / np.maximum(np.sqrt((v**2).sum(axis=1, keepdims=True)), 1e-9)


def _groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for start in range(0, len(column), _ROWS):
        for low, high, data, offsets in T.chunks(column.slice(start, _ROWS)):
            yield start + low, start + high, data, offsets


def fit(documents: DataFrame, labels: DataFrame, trained: Column | None = None, n_documents: int = FIT_DOCUMENTS) -> Model:
    """Fit on the ``n_documents`` labelled documents that come first by a hash of their id.

    ``labels`` has doc_id and quality; ``trained`` is a condition on doc_id for rows that may be learnt from.
    """
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality is not null")
    if trained is not None:
        marked = marked.filter(trained)
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n_documents)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in _groups(batch.column(1)):
                x = terms(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low),
                     pa.array([v.astype("<f2").tobytes() for v in x], pa.binary()), pa.array(np.diff(offsets), pa.int64())],
                    names=["doc_id", "quality", "terms", "size"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, quality int, terms binary, size long")
    found = found.groupBy("doc_id").agg(F.min(F.struct("quality", "size", "terms")).alias("x")).orderBy("doc_id").collect()
    full = [r.x for r in found if r.x["size"]]
    none = [int(r.x.quality > 0) for r in found if not r.x["size"]]
    width = BUCKETS + _SHAPES * _BINS
    if not full:
        return Model(np.ones(width, "f4"), np.zeros((width, 1), "f4"), np.zeros((0, 1), "f4"), np.zeros(0, "f4"), (sum(none) + 0.5) / (len(none) + 1))
    x = np.array([np.frombuffer(bytes(r.terms), dtype="<f2") for r in full], dtype=np.float32)
    y = np.array([int(r.quality > 0) for r in full], dtype=np.float32)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 0.3
    weighted = x * idf
    _, directions = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    directions = directions[:, ::-1][:, : min(DIRECTIONS, len(x))].astype(np.float32)
    return Model(idf, directions, _project(x, idf, directions), y, (sum(none) + float(y.mean())) / (len(none) + 1))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` and ``score``, from 0 to 1."""
    inner, restore = shield(documents, ["text"])
    k = min(K, len(model.labels))

    def votes(x: np.ndarray, length: np.ndarray) -> np.ndarray:
        if not k:
            return np.where(length > 0, 0.5, model.empty)
        cosine = _project(x, model.idf, model.directions) @ model.vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < cosine.shape[1] else np.broadcast_to(np.arange(k), cosine.shape)
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS + 1e-9
        found = (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(np.where(length > 0, found, model.empty), 0, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [votes(terms(data, offsets), np.diff(offsets)) for _, _, data, offsets in _groups(batch.column(batch.schema.get_field_index("text")))]
            found = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "score"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema)
    return restore(inner.mapInArrow(run, f"{columns}, score double"), "score")
