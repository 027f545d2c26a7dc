"""Elias-Fano code of a non-decreasing sequence of non-negative integers.

Each value is split: the low ``l`` bits are packed as they are, the high parts are
written in unary, one set bit per value.  Value i is found by selecting the i-th set bit.
The select directory keeps one 32-bit count per 512 bits, so the whole code takes about
2 + log2(universe / n) bits a value and no table of 64-bit offsets.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQBQ")  # values, universe, low bits, bytes of the high part
_BLOCK = 64  # bytes covered by one directory entry


class EliasFano:
    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low, self.high, self.ranks = low, high, ranks

    @classmethod
    def build(cls, values) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        universe = int(v[-1]) + 1 if n else 1
        l = max(0, (universe // max(n, 1)).bit_length() - 1)
        if l:
            shifts = np.arange(l, dtype=np.uint64)
            bits = ((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
            low = np.packbits(bits.ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        ones = (v >> np.uint64(l)).astype(np.int64) + np.arange(n)
        size = int(ones[-1]) + 1 if n else 0
        size = -(-max(size, 1) // (8 * _BLOCK)) * 8 * _BLOCK
        flags = np.zeros(size, np.uint8)
        flags[ones] = 1
        high = np.packbits(flags, bitorder="little")
        return cls(n, universe, l, low, high, cls._directory(high))

    @staticmethod
    def _directory(high: np.ndarray) -> np.ndarray:
        per_block = np.unpackbits(high).reshape(-1, 8 * _BLOCK).sum(axis=1, dtype=np.int64)
        return np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32)

    def select(self, index) -> np.ndarray:
        """Values at the given positions, through the directory and one block each."""
        i = np.asarray(index, np.int64)
        block = np.searchsorted(self.ranks, i, "right") - 1
        rows = np.unpackbits(self.high.reshape(-1, _BLOCK)[block], axis=1, bitorder="little")
        inner = np.cumsum(rows, axis=1, dtype=np.int32)
        at = np.argmax(inner == (i - self.ranks[block].astype(np.int64) + 1)[:, None], axis=1)
        value = (block * 8 * _BLOCK + at - i) << self.low_bits
        for b in range(self.low_bits):
            bit = i * self.low_bits + b
            value = value | (((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.int64) << b)
        return value

    def values(self, step: int = 4096) -> np.ndarray:
        """All values, by selects over ``step`` positions at a time."""
        parts = [self.select(np.arange(lo, min(self.n, lo + step))) for lo in range(0, self.n, step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def to_bytes(self) -> bytes:
        return b"".join([_HEAD.pack(self.n, self.universe, self.low_bits, len(self.high)),
                         self.ranks.astype("<u4").tobytes(), self.low.tobytes(), self.high.tobytes()])

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """(code, bytes read)."""
        n, universe, l, size = _HEAD.unpack_from(data)
        at = _HEAD.size
        n_ranks = size // _BLOCK + 1
        ranks = np.frombuffer(data, "<u4", n_ranks, at)
        at += 4 * n_ranks
        n_low = -(-n * l // 8)
        low = np.frombuffer(data, np.uint8, n_low, at)
        at += n_low
        high = np.frombuffer(data, np.uint8, size, at)
        return cls(n, universe, l, low, high, ranks), at + size
