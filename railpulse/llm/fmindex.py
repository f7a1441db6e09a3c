"""A compressed FM-index of word sequences, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


class _Bits:
    """A packed bit vector with vectorized rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded).view(">u8").astype(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, rest = i >> 6, (i & 63).astype(np.uint64)
        # Two shifts, as one by 64 is undefined.
        part = self.words[word] >> np.uint64(1) >> (np.uint64(63) - rest)
        return self.before[word] + np.bitwise_count(part)


def suffix_order(
    symbols: np.ndarray, distinct_first: int, depth: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, by doubling the compared length, and for the suffix at each place
    the range of this order that begins with the same ``depth`` symbols, a power of two.
    Symbols below ``distinct_first`` are all different and end every comparison."""
    n = len(symbols)
    rank, step = symbols.astype(np.int64), 1
    starts = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
    low, high = starts[symbols], starts[symbols + 1]
    while True:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + distinct_first + int(symbols.max()) + 2) + second
        order = np.argsort(key)
        fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if 2 * step <= depth:
            starts = np.append(np.flatnonzero(fresh), n)
            low, high = starts[rank], starts[rank + 1]
        if fresh.all() or step >= n:
            return order, low, high
        step *= 2


class FMIndex:
    """Sequences of words, each with a number of copies.

    The Burrows-Wheeler transform of all sequences is kept as a wavelet matrix of packed
    bit planes; a running sum of copies in suffix order tells how often a pattern occurs.
    The range of suffixes that begin with the same ``depth`` words, a power of two, is kept
    for every place.
    """

    def __init__(self, sequences: list[list[bytes]], copies: np.ndarray, depth: int = 1):
        count = len(sequences)
        code: dict[bytes, int] = {}
        flat = [code.setdefault(w, len(code)) for s in sequences for w in s]
        sizes = np.fromiter(map(len, sequences), np.int64, count)
        #: First place of each sequence; a separator follows its last word.
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
        self.sizes, self.copies = sizes, copies
        symbols = np.empty(int(sizes.sum()) + count, np.int64)
        ends = self.first + sizes
        symbols[ends] = np.arange(count)
        inner = np.ones(len(symbols), bool)
        inner[ends] = False
        symbols[inner] = np.array(flat, np.int64) + count
        order, low, high = suffix_order(symbols, count, depth)
        self.depth, self.low, self.high = depth, low.astype(np.int32), high.astype(np.int32)
        owner = np.repeat(np.arange(count), sizes + 1)
        self.weight = np.concatenate([[0], np.cumsum(copies[owner[order]])])
        # Separators are one symbol, 0, from here on; words are 1 and up.
        self.symbols = np.where(symbols < count, 0, symbols - count + 1)
        transform = self.symbols[order - 1]
        self.n, self.levels = len(symbols), max(1, len(code).bit_length())
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.symbols, minlength=len(code) + 1))])
        self.planes, self.zeros, current = [], [], transform
        for level in range(self.levels - 1, -1, -1):
            ones = (current >> level & 1).astype(bool)
            self.planes.append(_Bits(ones))
            self.zeros.append(int(len(current) - np.count_nonzero(ones)))
            current = np.concatenate([current[~ones], current[ones]])
        #: From a symbol's block at the bottom of the matrix to its block of suffixes.
        every = np.arange(len(code) + 1)
        self.shift = starts[:-1] - self._down(np.zeros(len(every), np.int64), every)

    def _down(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for level, plane, zeros in zip(
            range(self.levels - 1, -1, -1), self.planes, self.zeros, strict=True
        ):
            ones = plane.rank(at)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at

    def repeated(self, window: int) -> np.ndarray:
        """Per sequence a bit mask of its windows of that many words, by first word, that
        occur at least twice among all copies of all sequences.

        The search of a window begins with the range of its last ``depth`` words, known
        from the order of suffixes; each step extends all windows by a word to the left.
        ``window`` is ``depth`` at least.
        """
        count = self.sizes - window + 1
        masks = np.zeros(len(self.sizes), np.int64)
        # A sequence that occurs twice as a whole has all of its windows twice.
        whole = (count > 0) & (self.copies >= 2)
        masks[whole] = (1 << count[whole]) - 1
        rest = np.flatnonzero((count > 0) & ~whole)
        owner = np.repeat(rest, count[rest])
        number = np.arange(len(owner)) - np.repeat(np.cumsum(count[rest]) - count[rest], count[rest])
        at = self.first[owner] + number + (window - self.depth)
        low, high = self.low[at].astype(np.int64), self.high[at].astype(np.int64)
        for step in range(window - self.depth + 1):
            if step:
                symbol = self.symbols[at]
                move = self.shift[symbol]
                low, high = self._down(low, symbol) + move, self._down(high, symbol) + move
            fit = self.weight[high] - self.weight[low] >= 2
            owner, number, at = owner[fit], number[fit], at[fit] - 1
            low, high = low[fit], high[fit]
        np.bitwise_or.at(masks, owner, 1 << number)
        return masks
