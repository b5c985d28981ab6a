"""Words, lines and hashes of whole texts, a batch of texts at a time.

The functions work on the UTF-8 bytes of an Arrow column. A batch is cut into groups of whole texts of
about ``CHUNK_BYTES``, which bounds the memory of a task by that size or by its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D | 1


def _class(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


#: Bytes of words that are parted by white space, and of words of letters and digits.
SPACED = ~_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = ~_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


_LETTERS: dict[bool, np.ndarray] = {}


def _letters(fold: bool) -> np.ndarray:
    if fold not in _LETTERS:
        table = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
        if fold:
            table[0x41:0x5B] = table[0x61:0x7B]
        _LETTERS[fold] = table
    return _LETTERS[fold]


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and ``base ** -i`` modulo 2**64 for i < n at least."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, last row (exclusive), bytes and offsets of groups of whole texts; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Spans:
    """Parts of a group of texts: byte ranges, the text each belongs to, and where each text's parts begin."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Spans:
    """Maximal runs of bytes of ``kind`` within each text."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = kind[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # A run that goes on over the border of two texts is cut there.
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    if len(cut):
        cut = cut[(inside[cut] & inside[cut + 1]) == 1]
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    return _of_texts(start, end, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """Parts between line feeds; a text of no bytes has one empty line."""
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    end = np.sort(np.concatenate([offsets[1:], feeds]))
    text = np.repeat(np.arange(len(offsets) - 1), 1 + np.diff(np.searchsorted(feeds, offsets)))
    return Spans(start, end, text, np.searchsorted(text, np.arange(len(offsets))))


def _of_texts(start: np.ndarray, end: np.ndarray, offsets: np.ndarray) -> Spans:
    text = np.searchsorted(offsets, start, side="right") - 1
    return Spans(start, end, text, np.searchsorted(text, np.arange(len(offsets))))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit hash of each byte range, with A-Z taken as a-z if ``fold``."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_letters(fold)[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _ODD)


def grams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive parts within each text, and the number of the first part of each."""
    size = len(h) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    out = h[:size].copy()
    for i in range(1, n):
        out = out * _ODD + h[i : i + size]
    inside = np.ones(size, dtype=bool)
    for i in range(1, n):  # a window that starts less than n before the next text runs over its border
        late = first[1:-1] - i
        inside[late[(late >= 0) & (late < size)]] = False
    at = np.flatnonzero(inside)
    return mix(out[at] + np.uint64(n)), at


def first_and_repeated(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part: whether its hash was seen earlier in its text, and whether it is there twice or more."""
    n = len(h)
    earlier, repeated = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    if n:
        order = np.lexsort((h, text)) if text[-1] else np.argsort(h, kind="stable")
        same = (h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])
        earlier[order[1:]] = same
        repeated[order[1:]] = same
        repeated[order[:-1]] |= same
    return earlier, repeated


def sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over ranges of positions."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[end] - total[start]
