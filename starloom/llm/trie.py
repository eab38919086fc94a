"""A bigram trie in Elias-Fano levels: flat buffers that can be mapped from memory, searched in whole arrays at a time."""

from __future__ import annotations

import mmap

import numpy as np

CODES = 65_535  # levels of quantised probabilities; code 0 stands for none
LEAST = 1e-12  # smallest probability that is told apart


def quantised(p: np.ndarray) -> np.ndarray:
    """Codes of probabilities on a logarithmic grid; neighbours differ by a factor of about 1.0004."""
    scaled = np.log(np.maximum(p, LEAST) / LEAST) / -np.log(LEAST) * (CODES - 1)
    return np.where(p > 0, 1 + np.rint(scaled), 0).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    """The probabilities that codes stand for."""
    return np.where(codes > 0, LEAST * np.exp((codes.astype(np.float64) - 1) / (CODES - 1) * -np.log(LEAST)), 0.0)


def _select(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th (from 0) set bit in each 64-bit word."""
    place = np.zeros(len(r), np.int64)
    words, r = words.copy(), r.copy()
    for half in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & np.uint64((1 << half) - 1)).astype(np.int64)
        go = r >= below
        r -= np.where(go, below, 0)
        place += np.where(go, half, 0)
        words = np.where(go, words >> np.uint64(half), words)
    return place


class EliasFano:
    """A sorted sequence of unsigned 64-bit numbers: low bits packed, high bits in unary with counts by word."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones, self.zeros = n, low_bits, low, high, ones, zeros
        self.loads = np.lib.stride_tricks.as_strided(low[:8].view("<u8"), (max(1, len(low) - 7),), (1,))

    @classmethod
    def of(cls, x: np.ndarray) -> "EliasFano":
        n = len(x)
        top = int(x[-1]) if n else 0
        low_bits = min(57, max(0, ((top + 1) // max(n, 1)).bit_length() - 1))
        shift = np.uint64(low_bits)
        packed = np.zeros(0, np.uint8)
        if low_bits and n:
            low = (x & np.uint64((1 << low_bits) - 1)).astype("<u8")
            bits = np.unpackbits(low.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :low_bits]
            packed = np.packbits(bits, bitorder="little")
        low = np.r_[packed, np.zeros(8, np.uint8)]
        parts = (x >> shift).astype(np.int64)
        size = n + (int(parts[-1]) if n else 0) + 2
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[parts + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        count = np.bitwise_count(high).astype(np.int64)
        return cls(n, low_bits, low, high, np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(64 - count)])

    def buffers(self) -> list[np.ndarray]:
        return [self.low, self.high, self.ones, self.zeros]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        return self.loads[at >> 3] >> (at & 7).astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places i."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = word * 64 + _select(self.high[word], i - self.ones[word])
        return (place - i).astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Places of numbers in the sequence, -1 where absent: select the bucket of the high bits, then search its low bits."""
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        part = (x >> np.uint64(self.low_bits)).astype(np.int64)
        low = x & np.uint64((1 << self.low_bits) - 1)
        rows = np.flatnonzero(part < self.zeros[-1])
        part, low = part[rows], low[rows]
        start, end = self._after_zero(part - 1) - part, self._after_zero(part) - 1 - part
        while len(rows):  # halve what is left of each bucket
            open_ = start < end
            rows, part, low, start, end = rows[open_], part[open_], low[open_], start[open_], end[open_]
            middle = (start + end) >> 1
            value = self._low(middle)
            same = value == low
            out[rows[same]] = middle[same]
            start, end = np.where(value < low, middle + 1, start), np.where(value < low, end, middle)
            rows, part, low, start, end = rows[~same], part[~same], low[~same], start[~same], end[~same]
        return out

    def _after_zero(self, r: np.ndarray) -> np.ndarray:
        """Place after the r-th zero of the high bits; 0 for r = -1."""
        word = np.maximum(np.searchsorted(self.zeros, r, side="right") - 1, 0)
        return np.where(r < 0, 0, word * 64 + _select(~self.high[word], np.maximum(r - self.zeros[word], 0)) + 1)


class BigramTrie:
    """Level 1: contexts and pointers to their successors; level 2: successors, relative to their context, with quantised probabilities.

    Contexts are 64-bit numbers, successors have SUCCESSOR_BITS. Level 2 holds a context's place in level 1 as the high bits
    above its successors, so it is one monotone sequence over all contexts.
    """

    SUCCESSOR_BITS = 40

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def of(cls, context: np.ndarray, successor: np.ndarray, probability: np.ndarray) -> "BigramTrie":
        """From rows sorted by (context, successor), all different."""
        first = np.r_[True, context[1:] != context[:-1]][:len(context)]
        row = (np.cumsum(first) - 1).astype(np.uint64)
        starts = np.r_[np.flatnonzero(first), len(context)].astype(np.uint64)
        return cls(EliasFano.of(context[first]), EliasFano.of(starts), EliasFano.of(row << np.uint64(cls.SUCCESSOR_BITS) | successor),
                   quantised(probability))._mapped()

    def _mapped(self) -> "BigramTrie":
        """The same trie with all buffers in one mapped region, which no garbage collector moves or copies."""
        levels = (self.contexts, self.pointers, self.successors)
        buffers = [b for level in levels for b in level.buffers()] + [self.codes]
        sizes = [-(-b.nbytes // 8) * 8 for b in buffers]
        region = mmap.mmap(-1, max(8, sum(sizes)))
        views, at = [], 0
        for b, size in zip(buffers, sizes):
            view = np.frombuffer(region, b.dtype, len(b), at)
            view[:] = b
            views.append(view)
            at += size
        rebuilt = [EliasFano(level.n, level.low_bits, *views[4 * k:4 * k + 4]) for k, level in enumerate(levels)]
        return BigramTrie(*rebuilt, views[-1])

    def codes_of(self, context: np.ndarray, fan: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Codes of pairs, 0 for those the trie does not hold. Context k is that of the next fan[k] successors."""
        row = np.repeat(self.contexts.find(context), fan)
        out = np.zeros(len(successor), np.uint16)
        asked = np.flatnonzero(row >= 0)
        at = self.successors.find(row[asked].astype(np.uint64) << np.uint64(self.SUCCESSOR_BITS) | successor[asked])
        out[asked[at >= 0]] = self.codes[at[at >= 0]]
        return out

    def successors_of(self, context: int) -> list[tuple[int, float]]:
        """A context's successors with their restored probabilities, by its pointers."""
        row = self.contexts.find(np.array([context], np.uint64))
        if row[0] < 0:
            return []
        low, high = self.pointers.get(np.r_[row, row + 1]).astype(np.int64)
        successors = self.successors.get(np.arange(low, high)) & np.uint64((1 << self.SUCCESSOR_BITS) - 1)
        return list(zip(successors.tolist(), restored(self.codes[low:high]).tolist()))
