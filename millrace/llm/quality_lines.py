"""Quality rules by line labelling: a linear-chain conditional random field marks content and boilerplate.

Every line of a text gets a feature vector (``analyse``). ``fit`` learns emission and transition weights on all
lines of a bounded sample of labelled documents. Labels of lines come from below the documents' labels:
weights of single lines are learnt first, then each line takes the label that they prefer, as long as most
characters of a document keep its label (``line_labels``); the chain is learnt from those sequences.
``label_documents`` decodes the best label sequence of every whole text (Viterbi) and decides by the share
of word characters that lie in content lines.

Cases: a null or empty text has no words, fails the base rule and is not kept. Repeated rows are labelled
one by one and alike. Lines without a word take part in no count and are skipped by the decoder. Without labelled
documents of both classes the model marks every line as content, so that only the base rule decides. Of several
labels of one id the smallest counts, of several texts one. Ids may be of any type that can be ordered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T
from millrace.llm.columns import shield

#: Sample that the model is fitted on: all lines of so many documents.
FIT_DOCUMENTS = 2000
#: Longer sequences are learnt in pieces of so many lines.
PIECE = 64
#: A document is kept if at least this share of its word characters lies in content lines.
CONTENT_SHARE = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"

FEATURES = (
    "bias", "symbols", "symbols_per_word", "upper", "marks", "bars", "digits", "word_length", "short_line",
    "repeated_words", "repeated_next", "repeated_line", "open_end",
)
_N = len(FEATURES)

_SYMBOL, _UPPER, _LETTER, _MARK, _DIGIT = (np.zeros(256, dtype=bool) for _ in range(5))
_SYMBOL[list(SYMBOLS)] = True
_UPPER[0x41:0x5B] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK[list(b"!?")] = True
_DIGIT[0x30:0x3A] = True
_CODE_POINT = (np.arange(256) & 0xC0) != 0x80
_CLOSING = np.zeros(256, dtype=bool)
_CLOSING[list(b".!?:;\"')")] = True


@dataclass(frozen=True)
class Model:
    """Weights of emission (label x feature) and transition (label x label); label 1 is content."""

    emission: np.ndarray
    transition: np.ndarray


@dataclass
class Counts:
    """What the base rules count in each text of a group, and its lines with their features."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    lines: T.Spans
    features: np.ndarray
    line_chars: np.ndarray


def analyse(data: np.ndarray, offsets: np.ndarray) -> Counts:
    w = T.words(data, offsets, T.SPACED)
    code = _CODE_POINT[data]
    word_h = T.hashes(data, w.start, w.end, fold=False)
    chars = T.sums(code, w.start, w.end)
    total_chars = np.zeros(len(chars) + 1, dtype=np.int64)
    np.cumsum(chars, out=total_chars[1:])

    # Words in windows of three that are found twice or more in their text.
    gram, at = T.grams(word_h, w.first, 3)
    _, repeated = T.first_and_repeated(w.text[at], gram)
    covered = np.zeros(len(w.start) + 3, dtype=np.int32)
    hit = at[repeated]
    covered[hit] += 1
    covered[hit + 3] -= 1
    in_repeat = np.cumsum(covered)[: len(w.start)] > 0

    # Lines that have a word.
    every = T.lines(data, offsets)
    first_word = np.searchsorted(w.start, every.start)
    last_word = np.searchsorted(w.start, every.end)
    full = last_word > first_word
    start, end, line_text = every.start[full], every.end[full], every.text[full]
    first_word, last_word = first_word[full], last_word[full]
    line_h = T.hashes(data, start, end, fold=False)
    earlier, _ = T.first_and_repeated(line_text, line_h)
    lines = T.Spans(start, end, line_text, np.searchsorted(line_text, np.arange(len(offsets))))

    n_words = (last_word - first_word).astype(np.float64)
    line_chars = total_chars[last_word] - total_chars[first_word]
    n_chars = np.maximum(line_chars, 1).astype(np.float64)
    same_next = np.zeros(len(word_h), dtype=np.int64)
    if len(word_h) > 1:
        same_next[:-1] = (word_h[1:] == word_h[:-1]) & (w.text[1:] == w.text[:-1])
    single_bar = ((w.end - w.start) == 1) & (data[w.start] == 0x7C) if len(w.start) else np.zeros(0, dtype=bool)
    features = np.empty((len(start), _N))
    features[:, 0] = 1.0
    symbols = T.sums(_SYMBOL[data], start, end)
    features[:, 1] = symbols / n_chars
    features[:, 2] = np.minimum(symbols / n_words, 3.0)
    features[:, 3] = T.sums(_UPPER[data], start, end) / np.maximum(T.sums(_LETTER[data], start, end), 1)
    features[:, 4] = np.minimum(T.sums(_MARK[data], start, end) / n_words, 3.0)
    features[:, 5] = T.sums(single_bar, first_word, last_word) / n_words
    features[:, 6] = T.sums(_DIGIT[data], start, end) / n_chars
    features[:, 7] = np.minimum(line_chars / n_words, 30.0) / 10.0
    features[:, 8] = n_words < 4
    features[:, 9] = T.sums(in_repeat, first_word, last_word) / n_words
    features[:, 10] = T.sums(same_next, first_word, last_word) / n_words
    features[:, 11] = earlier
    features[:, 12] = ~_CLOSING[data[w.end[last_word - 1] - 1]] if len(start) else 0
    return Counts(
        w.per_text, np.diff(total_chars[w.first]), T.sums(_SYMBOL[data], offsets[:-1], offsets[1:]),
        np.bincount(line_text, weights=earlier, minlength=len(offsets) - 1).astype(np.int64),
        np.bincount(w.text, weights=in_repeat, minlength=len(offsets) - 1).astype(np.int64),
        lines, features, line_chars,
    )


def viterbi(scores: np.ndarray, first: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The best label of each line; lines of text t are ``first[t]`` to ``first[t + 1]``.

    One step takes the next line of all texts that still have one, so a step costs as much as there are
    such texts. Ties go to content.
    """
    n, length = len(scores), np.diff(first)
    label = np.zeros(n, dtype=np.int8)
    if not n:
        return label
    by_length = np.argsort(-length, kind="stable")
    active_at = np.searchsorted(-length[by_length], -np.arange(int(length.max()) + 1), side="left")
    best = np.zeros((len(length), 2))
    back = np.zeros((n, 2), dtype=np.int8)
    for step in range(int(length.max())):
        rows = by_length[: active_at[step]]
        at = first[rows] + step
        if step == 0:
            best[rows] = scores[at]
            continue
        via = best[rows][:, :, None] + transition[None]
        back[at] = via[:, 1, :] >= via[:, 0, :]
        best[rows] = via.max(axis=1) + scores[at]
    some = np.flatnonzero(length > 0)
    label[first[some + 1] - 1] = best[some, 1] >= best[some, 0]
    for step in range(int(length.max()) - 1, 0, -1):
        rows = by_length[: active_at[step]]
        at = first[rows] + step
        label[at - 1] = back[at, label[at]]
    return label


def _content_share(c: Counts, model: Model) -> np.ndarray:
    n = len(c.lines.first) - 1
    scores = c.features @ model.emission.T
    label = viterbi(scores, c.lines.first, model.transition)
    total = np.bincount(c.lines.text, weights=c.line_chars, minlength=n)
    content = np.bincount(c.lines.text, weights=c.line_chars * label, minlength=n)
    return content / np.maximum(total, 1)


def line_labels(lines: list[np.ndarray], chars: list[np.ndarray], labels: np.ndarray, emission: np.ndarray) -> list[np.ndarray]:
    """The label of each line that ``emission`` prefers; lines that agree best keep the label of their document,
    until they hold more than half of its characters."""
    out = []
    for x, size, label in zip(lines, chars, labels):
        agrees = (x @ (emission[1] - emission[0])) * (1 if label else -1)
        order = np.argsort(-agrees, kind="stable")
        before = np.cumsum(size[order]) - size[order]
        keeps = agrees >= 0
        keeps[order[2 * before <= size.sum()]] = True
        out.append(np.where(keeps, label, 1 - label).astype(np.int64))
    return out


def train(lines: list[np.ndarray], chars: list[np.ndarray], labels: np.ndarray) -> Model:
    """Weights from the features and characters of each document's lines and the documents' labels."""
    keep = [i for i, x in enumerate(lines) if len(x)]
    if not keep or len(set(labels[keep].tolist())) < 2:
        return Model(np.zeros((2, _N)), np.zeros((2, 2)))
    lines, chars, labels = [lines[i] for i in keep], [chars[i] for i in keep], labels[keep].astype(np.int64)
    # Both classes count alike, and so do long and short documents.
    share = np.bincount(labels, minlength=2)
    weights = [0.5 / share[label] / len(x) for x, label in zip(lines, labels)]
    whole = np.concatenate(lines)
    alone = likely(
        [whole[i : i + 1] for i in range(len(whole))], list(np.repeat(labels, [len(x) for x in lines])[:, None]),
        np.repeat(weights, [len(x) for x in lines]))
    marked = line_labels(lines, chars, labels, alone.emission)
    cut = [(d, k) for d, x in enumerate(lines) for k in range(0, len(x), PIECE)]
    return likely([lines[d][k : k + PIECE] for d, k in cut], [marked[d][k : k + PIECE] for d, k in cut], np.array([weights[d] for d, _ in cut]))


def likely(lines: list[np.ndarray], marked: list[np.ndarray], weight: np.ndarray, rounds: int = 150, rate: float = 0.15, l2: float = 1e-3) -> Model:
    """Weights that make label sequences likely (gradient ascent on the log-likelihood).

    ``lines`` holds the features of the lines of each sequence, ``marked`` their labels, ``weight`` what a line counts.
    """
    order = sorted(range(len(lines)), key=lambda i: -len(lines[i]))
    n, longest = len(order), len(lines[order[0]])
    x = np.zeros((n, longest, _N))
    mask = np.zeros((n, longest), dtype=bool)
    for row, i in enumerate(order):
        x[row, : len(lines[i])] = lines[i]
        mask[row, : len(lines[i])] = True
    y = np.zeros((n, longest), dtype=np.int64)
    for row, i in enumerate(order):
        y[row, : len(marked[i])] = marked[i]
    length, weight = mask.sum(axis=1), np.asarray(weight)[order]
    active = [int((length > t).sum()) for t in range(longest)]
    emission, transition = np.zeros((2, _N)), np.zeros((2, 2))
    m1, m2 = np.zeros(2 * _N + 4), np.zeros(2 * _N + 4)
    gold = np.stack([y == 0, y == 1], axis=2) * mask[:, :, None].astype(np.float64)
    gold_pairs = np.einsum("nta,ntb,n->ab", gold[:, :-1], gold[:, 1:], weight)
    for step in range(1, rounds + 1):
        scores = x @ emission.T
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            a = active[t]
            forward[:a, t] = np.logaddexp.reduce(forward[:a, t - 1, :, None] + transition, axis=1) + scores[:a, t]
        for t in range(longest - 2, -1, -1):
            a = active[t + 1]
            backward[:a, t] = np.logaddexp.reduce(transition + (scores[:a, t + 1] + backward[:a, t + 1])[:, None, :], axis=2)
        z = np.logaddexp.reduce(forward[:, 0] + backward[:, 0], axis=1)
        node = np.exp(forward + backward - z[:, None, None]) * mask[:, :, None]
        pairs = np.zeros((2, 2))
        for t in range(1, longest):
            a = active[t]
            log_pair = forward[:a, t - 1, :, None] + transition + (scores[:a, t] + backward[:a, t])[:, None, :] - z[:a, None, None]
            pairs += (weight[:a, None, None] * np.exp(log_pair)).sum(axis=0)
        slope = np.concatenate([
            np.einsum("ntk,ntf,n->kf", gold - node, x, weight).ravel() - l2 * emission.ravel(),
            (gold_pairs - pairs).ravel() - l2 * transition.ravel(),
        ])
        m1 = 0.9 * m1 + 0.1 * slope
        m2 = 0.999 * m2 + 0.001 * slope**2
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        emission += move[: 2 * _N].reshape(2, _N)
        transition += move[2 * _N :].reshape(2, 2)
    return Model(emission, transition)


def fit(documents: DataFrame, labels: DataFrame, n_documents: int = FIT_DOCUMENTS) -> Model:
    """Fit on the ``n_documents`` labelled documents that come first by a hash of their id.

    The driver gets the feature vectors of the lines of so many documents, whatever the size of the tables.
    """
    # One label per document: the smallest, if rows repeat.
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality")).filter("_id is not null and _quality is not null")
    marked = marked.groupBy("_id").agg(F.min("_quality").alias("_quality"))
    chosen = marked.orderBy(F.xxhash64("_id"), "_id").limit(n_documents)
    rows = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).join(F.broadcast(chosen), "_id")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in T.chunks(batch.column(1)):
                c = analyse(data, offsets)
                every = np.column_stack([c.features, c.line_chars]).astype("<f4")
                kept = [every[c.lines.first[i] : c.lines.first[i + 1]].tobytes() for i in range(high - low)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low), pa.array(kept, pa.binary())],
                    names=["id", "quality", "lines"],
                )

    id_type = rows.schema["_id"].dataType.simpleString()
    found = rows.select("_id", "_text", F.col("_quality").cast("int")).mapInArrow(sample, f"id {id_type}, quality int, lines binary")
    # Copies of one id are as many rows as the table holds; one of them is enough.
    found = found.groupBy("id").agg(F.min(F.struct("quality", "lines")).alias("x")).orderBy("id").collect()
    features = [np.frombuffer(bytes(r.x.lines), dtype="<f4").reshape(-1, _N + 1).astype(np.float64) for r in found]
    return train([x[:, :_N] for x in features], [x[:, _N] for x in features], np.array([int(r.x.quality > 0) for r in found], dtype=np.int64))


def label_documents(documents: DataFrame, model: Model, min_words: int = MIN_WORDS, content_share: float = CONTENT_SHARE) -> DataFrame:
    """All columns of ``documents`` and a struct ``quality_lines``: the base counts, ``content_share`` and ``kept``."""
    documents, restore = shield(documents, ["text"])
    schema = documents.schema
    inner = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,content_share:double,kept:boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in T.chunks(batch.column(batch.schema.get_field_index("text"))):
                c = analyse(data, offsets)
                failed = (c.n_words < min_words) | (100 * c.n_repeat_words > 50 * c.n_words)
                share = _content_share(c, model)
                found = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, failed, share, ~failed & (share >= content_share))],
                    names=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"],
                )
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, "quality_lines"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return restore(documents.mapInArrow(run, f"{columns}, quality_lines {inner}"), "quality_lines")
