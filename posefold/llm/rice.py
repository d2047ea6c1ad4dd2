"""Golomb-Rice coding of sorted distinct integers, as numpy passes over whole blocks."""

from __future__ import annotations

import numpy as np


def parameter(universe: int, count: int) -> int:
    """Low bits a gap: the power of two next below the mean gap."""
    return max(0, (max(universe, 1) // max(count, 1)).bit_length() - 1)


def encode(values: np.ndarray, low_bits: int) -> tuple[bytes, bytes]:
    """``(unary, low)`` of strictly ascending values: quotients of the gaps in unary, then low bits."""
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(-1)) - 1
    stops = np.cumsum((gaps >> low_bits) + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1 if len(stops) else 0, dtype=np.uint8)
    unary[stops] = 1
    low = (gaps[:, None] >> np.arange(low_bits)) & 1
    return np.packbits(unary).tobytes(), np.packbits(low.astype(np.uint8)).tobytes()


def decode(unary: bytes, low: bytes, low_bits: int, count: int) -> np.ndarray:
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:count].astype(np.int64)
    quotients = np.diff(stops, prepend=np.int64(-1)) - 1
    bits = np.unpackbits(np.frombuffer(low, np.uint8))[: count * low_bits].reshape(count, low_bits)
    gaps = (quotients << low_bits) + bits.astype(np.int64) @ (np.int64(1) << np.arange(low_bits, dtype=np.int64))
    return np.cumsum(gaps + 1) - 1
