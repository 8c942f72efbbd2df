"""Elias-Fano coding of a non-decreasing sequence, with a select structure for single values.

Each value is split: its low bits are packed side by side, its high part is written in unary as a
bit at (high part + index). That is about 2 + log2(universe / n) bits a value. Every ``STEP``-th
set bit has its position noted in 32 bits, so one value is found by scanning a few bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP = 512
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


@dataclass(frozen=True)
class EliasFano:
    count: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, int(values[-1] // n).bit_length() - 1)
        places = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, np.uint8)
        high[places] = 1
        low = (values[:, None] >> np.arange(low_bits)) & 1
        return cls(
            n,
            low_bits,
            np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            places[::STEP].astype("<u4").tobytes(),
        )

    def values(self) -> np.ndarray:
        """The whole sequence."""
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[: self.count] - np.arange(self.count)
        low = np.unpackbits(
            np.frombuffer(self.low, np.uint8), count=self.count * self.low_bits, bitorder="little"
        ).reshape(self.count, self.low_bits)
        return (high << self.low_bits) + low.astype(np.int64) @ (1 << np.arange(self.low_bits))

    def select(self, i: int) -> int:
        """The value at index ``i`` alone."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        start = int(np.frombuffer(self.samples, "<u4")[i // STEP])
        left = i % STEP
        at = start >> 3
        byte = self.high[at] >> (start & 7) << (start & 7)
        while left >= _ONES[byte]:
            left -= int(_ONES[byte])
            at += 1
            byte = self.high[at]
        for _ in range(left):
            byte &= byte - 1
        high = at * 8 + (byte & -byte).bit_length() - 1 - i
        first = i * self.low_bits
        last = first + self.low_bits
        window = int.from_bytes(self.low[first >> 3 : (last + 7) >> 3], "little")
        low = (window >> (first & 7)) & ((1 << self.low_bits) - 1)
        return (high << self.low_bits) + low
