"""Words of whole texts as numpy arrays, for the operators that run in Arrow batches.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return (``[^\\x20\\x09-\\x0D]+``). These bytes never occur inside a longer UTF-8 sequence, so whole batches
are cut without a loop over texts. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


class Words(NamedTuple):
    """``data``: the UTF-8 bytes of all texts; a word is ``data[start:end]``; text i has the words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = h.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(33)
    return h


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in runs of about ``limit`` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(column)
        at = np.cumsum(np.diff(offsets(sizes)))
        begin = 0
        while begin < batch.num_rows:
            done = at[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(at, done + limit, "right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets of the texts in their buffer; a null is empty."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def split(texts: pa.Array, lower: bool = False) -> Words:
    if texts.null_count:
        texts = texts.fill_null("")
    at = offsets(texts) if len(texts) else np.zeros(1, np.int64)
    buffer = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(buffer, np.uint8)[at[0] : at[-1]] if buffer is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if lower:
        data = LOWER[data]
    word = np.concatenate(([False], ~BLANK[data], [False]))
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    here, before = word[1:], word[:-1]
    start = np.flatnonzero(here & (~before | edge))
    end = np.flatnonzero(before & (~here | edge))
    return Words(data, at, start, end, np.searchsorted(start, at))


class Hasher:
    """64-bit numbers of words. ``seed`` gives another function."""

    def __init__(self, seed: int = 1):
        self.table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(seed))
        self.power = np.ones(1, np.uint64)
        self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _ODD, np.uint64))))
                self.back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _INVERSE, np.uint64))))

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of ``data[start:end]``; equal bytes give equal numbers wherever they stand."""
        self._grow(len(data))
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.table[data] * self.power[: len(data)], out=total[1:])
            return mix((total[end] - total[start]) * self.back[start])


def window_hash(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all runs of ``size`` words within one text, and the text of each run."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = (h ^ words[k : k + n]) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(29)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = text[:n] == text[size - 1 :]
    return mix(h[inside]), text[:n][inside]
