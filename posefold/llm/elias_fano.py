"""Elias-Fano coding of ascending integers with a select structure.

The low bits of every value are packed; the high bits are counted in unary, one set bit a value.
``select(i)`` finds the ``i``-th set bit from a sample every ``SAMPLE`` values and a scan of few
bytes, so a value costs about ``2 + log2(universe / n)`` bits and no table of 64-bit integers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 64
_ONES = np.array([bin(byte).count("1") for byte in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class EliasFano:
    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes  # byte of ``high`` and set bits before it, for every SAMPLE-th value (u4 pairs)

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = values.astype(np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        low = (values[:, None] >> np.arange(low_bits)) & 1
        stops = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(stops[-1]) + 1, dtype=np.uint8)
        high[stops] = 1
        packed = np.packbits(high)
        before = np.concatenate([[0], np.cumsum(_ONES[packed])])
        at = stops[::SAMPLE] // 8
        samples = np.stack([at, before[at]], axis=1).astype("<u4").tobytes()
        return cls(n, low_bits, np.packbits(low.astype(np.uint8)).tobytes(), packed.tobytes(), samples)

    def select(self, i: int) -> int:
        """The ``i``-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        byte, seen = np.frombuffer(self.samples, "<u4", 2, (i // SAMPLE) * 8).tolist()
        while seen + (ones := self.high[byte].bit_count()) <= i:
            byte, seen = byte + 1, seen + ones
        bits = self.high[byte]
        for place in range(8):
            if bits & (128 >> place):
                if seen == i:
                    break
                seen += 1
        first = i * self.low_bits
        last = first + self.low_bits
        word = int.from_bytes(self.low[first // 8 : (last + 7) // 8], "big") >> (-last % 8)
        # The packed bits of a value run from its lowest to its highest.
        low = int(format(word & ((1 << self.low_bits) - 1), f"0{self.low_bits}b")[::-1], 2) if self.low_bits else 0
        return ((byte * 8 + place - i) << self.low_bits) | low

    def all(self) -> np.ndarray:
        """Every value, by one pass over both bit arrays."""
        stops = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8)))[: self.n].astype(np.int64)
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8))[: self.n * self.low_bits]
        low = bits.reshape(self.n, self.low_bits).astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return ((stops - np.arange(self.n)) << self.low_bits) | low
