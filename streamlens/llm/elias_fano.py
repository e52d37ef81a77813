"""Elias-Fano sequences and a two-level n-gram trie made of them, queried for many n-grams at once."""

from __future__ import annotations

import mmap

import numpy as np

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_PLACE = np.zeros((256, 8), np.uint8)  # where the k-th set bit of a byte is
for _b in range(256):
    _at = [i for i in range(8) if _b >> i & 1]
    _PLACE[_b, : len(_at)] = _at


class EliasFano:
    """A growing sequence of numbers below ``universe``: low bits packed, high bits in unary."""

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n, self.universe = n, universe
        self.bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.bits)).astype(np.int64)
        size = n + (universe >> self.bits) + 2
        unary = np.zeros(-(-size // 64) * 64, bool)
        unary[high + np.arange(n)] = True
        self.high = np.packbits(unary, bitorder="little").view(np.uint64)
        self.low = np.zeros(n * self.bits // 64 + 2, np.uint64)
        if self.bits:
            at = np.arange(n, dtype=np.uint64) * np.uint64(self.bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            rest = values & np.uint64((1 << self.bits) - 1)
            np.bitwise_or.at(self.low, word, rest << shift)
            over = shift + np.uint64(self.bits) > 64
            np.bitwise_or.at(self.low, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
        self._count()

    def _count(self) -> None:
        zeros = 64 - np.bitwise_count(self.high).astype(np.int64)
        self.zeros = np.concatenate(([0], np.cumsum(zeros)))

    def parts(self) -> list[np.ndarray]:
        return [self.high, self.low, self.zeros]

    def place(self, parts: list[np.ndarray]) -> None:
        """Read from these arrays from now on."""
        self.high, self.low, self.zeros = parts

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        left = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | left) & np.uint64((1 << self.bits) - 1)

    def before(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below ``high``: the ones before the zero number ``high`` - 1."""
        out = np.zeros(len(high), np.int64)
        some = np.flatnonzero(high > 0)
        k = high[some] - 1
        word = np.searchsorted(self.zeros, k, "right") - 1
        rest = k - self.zeros[word]
        octets = (~self.high[word]).view(np.uint8).reshape(-1, 8)
        total = np.cumsum(_ONES[octets], axis=1, dtype=np.int64)
        byte = (total <= rest[:, None]).sum(axis=1)
        row = np.arange(len(some))
        inner = rest - np.where(byte > 0, total[row, byte - 1], 0)
        out[some] = word * 64 + byte * 8 + _PLACE[octets[row, byte], inner] - k
        return out

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first number that is not smaller, and whether it is equal."""
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.bits)).astype(np.int64)
        low = values & np.uint64((1 << self.bits) - 1)
        a, end = self.before(high), self.before(high + 1)
        b = end.copy()
        while (open_ := a < b).any():
            mid = (a + b) // 2
            less = open_ & (self.low_bits(np.minimum(mid, max(self.n - 1, 0))) < low)
            a = np.where(less, mid + 1, a)
            b = np.where(open_ & ~less, mid, b)
        at = np.minimum(a, max(self.n - 1, 0))
        return a, (a < end) & (self.low_bits(at) == low)


CODES = 65_000
STEP = 12**0.5 / CODES  # of the square root of -log10 p, so that probabilities near 1 are kept finely


class Trie:
    """Contexts, pointers to their followers, the followers, and a quantised probability for each.

    Follower w of context number i is stored as ``i * universe + w``, so the whole level grows and a follower is
    found by successor search inside its context's range. All levels lie in one memory map.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, probability: np.ndarray, universe: int):
        """From n-grams sorted by context and word, without repeats."""
        self.universe = universe
        first = np.flatnonzero(np.diff(context, prepend=-1))
        self.contexts = EliasFano(context[first], universe)
        self.pointers = EliasFano(np.append(first, len(context)), len(context) + 1)
        number = np.cumsum(np.diff(context, prepend=-1) != 0) - 1
        self.followers = EliasFano(number * universe + word, max(1, len(first)) * universe)
        code = np.clip(np.round(np.sqrt(-np.log10(np.clip(probability, 1e-12, 1))) / STEP), 0, CODES).astype(np.uint16)
        levels = [self.contexts, self.pointers, self.followers]
        arrays = [a for x in levels for a in x.parts()] + [code]
        size = sum(-(-a.nbytes // 8) * 8 for a in arrays)
        self.map = mmap.mmap(-1, max(size, 8))
        views, at = [], 0
        for a in arrays:
            view = np.frombuffer(self.map, a.dtype, len(a), at)
            view[:] = a
            views.append(view)
            at += -(-a.nbytes // 8) * 8
        for k, x in enumerate(levels):
            x.place(views[3 * k : 3 * k + 3])
        self.code = views[-1]

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes from 1 on, 0 for n-grams that are not stored."""
        out = np.zeros(len(context), np.uint16)
        if not self.contexts.n or not len(context):
            return out
        number, known = self.contexts.successor(context)
        at, found = self.followers.successor(np.where(known, number, 0) * self.universe + word)
        hit = known & found
        out[hit] = self.code[at[hit]] + 1
        return out


def decoded(code: np.ndarray) -> np.ndarray:
    """Probabilities of the codes of ``lookup``."""
    return np.where(code > 0, 10.0 ** -np.square((code.astype(float) - 1) * STEP), 0.0)
