"""Wavelet matrix of token ids: bit planes with rank and select in one compressed file."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"TWM1"
_BLOCK = 512  # bits per rank sample


class Plane:
    """A packed bit vector with a rank sample every ``_BLOCK`` bits."""

    def __init__(self, packed: np.ndarray, n: int):
        self.packed, self.n = packed, n
        counts = np.bitwise_count(packed).astype(np.int64)
        step = _BLOCK // 8
        padded = np.concatenate([counts, np.zeros(-len(counts) % step, np.int64)])
        self.samples = np.concatenate([[0], np.cumsum(padded.reshape(-1, step).sum(axis=1))])

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.n).view(bool)

    def bit(self, i: int) -> int:
        return int(self.packed[i >> 3]) >> (7 - (i & 7)) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first i bits."""
        block = i // _BLOCK
        first = block * _BLOCK // 8
        whole = self.packed[first : i >> 3]
        ones = int(self.samples[block]) + int(np.bitwise_count(whole).sum())
        if i & 7:
            ones += (int(self.packed[i >> 3]) >> (8 - (i & 7))).bit_count()
        return ones

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th bit of that kind, from 0."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            ones = self.rank1(middle + 1)
            if (ones if bit else middle + 1 - ones) > k:
                high = middle
            else:
                low = middle + 1
        return low


class WaveletMatrix:
    """A sequence of numbers below ``2 ** levels``, as one bit plane per level.

    Each plane holds one bit of every number, highest first; after each the numbers with
    a 0 move before those with a 1, in order. Access, counting and occurrence lookup walk
    the planes and need no other copy of the sequence.
    """

    def __init__(self, n: int, levels: int, planes: list[Plane], zeros: list[int]):
        self.n, self.levels, self.planes, self.zeros = n, levels, planes, zeros

    @classmethod
    def of(cls, values: np.ndarray, levels: int) -> WaveletMatrix:
        current, planes, zeros = np.asarray(values), [], []
        for level in range(levels - 1, -1, -1):
            ones = (current >> level & 1).astype(bool)
            planes.append(Plane(np.packbits(ones), len(current)))
            zeros.append(int(len(current) - np.count_nonzero(ones)))
            current = np.concatenate([current.compress(~ones), current.compress(ones)])
        return cls(len(current), levels, planes, zeros)

    def values(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        current = np.zeros(self.n, np.uint32 if self.levels > 16 else np.uint16)
        for level, (plane, zeros) in enumerate(
            zip(reversed(self.planes), reversed(self.zeros), strict=True)
        ):
            ones, above = plane.bits(), np.empty_like(current)
            above[~ones] = current[:zeros]
            above[ones] = current[zeros:] | (1 << level)
            current = above
        return current

    def access(self, i: int) -> int:
        """The number at place i."""
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.bit(i), plane.rank1(i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            a, b = plane.rank1(start), plane.rank1(end)
            if value >> (self.levels - 1 - level) & 1:
                start, end = zeros + a, zeros + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """How often a number occurs in a range."""
        if value >> self.levels:
            return 0
        a, b = self._range(value, start, self.n if end is None else end)
        return b - a

    def occurrence(self, value: int, k: int) -> int:
        """Place of the k-th occurrence of a number, from 0."""
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        at = self._range(value, 0, self.n)[0] + k
        for level in range(self.levels):
            plane, zeros = self.planes[-1 - level], self.zeros[-1 - level]
            at = plane.select(1, at - zeros) if value >> level & 1 else plane.select(0, at)
        return at

    def to_bytes(self) -> bytes:
        """One file: a header, then each plane with its number of zeros, compressed."""
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = [MAGIC, struct.pack("<QB", self.n, self.levels)]
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            body = pack(plane.packed.tobytes())
            parts += [struct.pack("<QQ", zeros, len(body)), body]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        n, levels = struct.unpack_from("<QB", data, 4)
        at, planes, zeros = 13, [], []
        unpack = zstandard.ZstdDecompressor().decompress
        for _ in range(levels):
            zero, size = struct.unpack_from("<QQ", data, at)
            at += 16
            packed = np.frombuffer(unpack(data[at : at + size]), np.uint8)
            planes.append(Plane(packed, n))
            zeros.append(zero)
            at += size
        return cls(n, levels, planes, zeros)
