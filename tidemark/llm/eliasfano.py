"""Elias-Fano coding of a non-decreasing sequence, with a select structure.

n values below u take the low l = floor(log2(u / n)) bits each, packed, and a bit vector in which value i sets bit
(value >> l) + i: about 2 + log2(u / n) bits a value. The place of every ``STEP``-th set bit is kept as 32 bits, so select
starts at most ``STEP`` set bits away from the one it looks for.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
_HEAD = "<IBII"  # values, low bits, bytes of the low part, bytes of the bit vector


def encode(values: np.ndarray) -> bytes:
    """The coded sequence; values are non-negative and non-decreasing."""
    n = len(values)
    values = values.astype(np.uint64)
    low = max(0, (int(values[-1] + np.uint64(1)) // n).bit_length() - 1) if n else 0
    bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    vector = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
    vector[places] = 1
    highs = np.packbits(vector, bitorder="little").tobytes()
    return struct.pack(_HEAD, n, low, len(lows), len(highs)) + lows + highs + places[::STEP].astype("<u4").tobytes()


class Sequence:
    """Reads a coded sequence at an offset of a buffer."""

    def __init__(self, data: bytes, at: int = 0):
        self.n, self.low, lows, highs = struct.unpack_from(_HEAD, data, at)
        at += struct.calcsize(_HEAD)
        self.lows = np.frombuffer(data, np.uint8, lows, at)
        self.highs = np.frombuffer(data, np.uint8, highs, at + lows)
        samples = -(-self.n // STEP)
        self.samples = np.frombuffer(data, "<u4", samples, at + lows + highs)
        self.end = at + lows + highs + 4 * samples

    def select(self, i: int) -> int:
        """Value i, from one sample and the bits behind it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, skip = int(self.samples[i // STEP]), i % STEP
        while True:
            byte = place // 8
            chunk = np.unpackbits(self.highs[byte : byte + 64], bitorder="little")[place % 8 :]
            ones = np.flatnonzero(chunk)
            if skip < len(ones):
                place += int(ones[skip])
                break
            skip -= len(ones)
            place += len(chunk)
        first = i * self.low
        bits = np.unpackbits(self.lows[first // 8 : (first + self.low + 7) // 8], bitorder="little")[first % 8 :][: self.low]
        return ((place - i) << self.low) | int((bits.astype(np.int64) << np.arange(self.low)).sum())

    def many(self, wanted: np.ndarray) -> np.ndarray:
        """The values of ascending indexes, each from its sample and the bits up to the next sample."""
        wanted, places = np.asarray(wanted, dtype=np.int64), np.zeros(len(wanted), dtype=np.int64)
        if len(wanted) and not 0 <= wanted[0] <= wanted[-1] < self.n:
            raise IndexError(f"not all of 0 to {self.n - 1}")
        groups, first = np.unique(wanted // STEP, return_index=True)
        for group, begin, end in zip(groups.tolist(), first.tolist(), [*first[1:].tolist(), len(wanted)]):
            place = int(self.samples[group])
            stop = int(self.samples[group + 1]) if group + 1 < len(self.samples) else 8 * len(self.highs)
            bits = np.unpackbits(self.highs[place // 8 : -(-stop // 8)], bitorder="little")[place % 8 :]
            places[begin:end] = place + np.flatnonzero(bits)[wanted[begin:end] % STEP]
        at = wanted[:, None] * self.low + np.arange(self.low)
        bits = (self.lows[at >> 3] >> (at & 7).astype(np.uint8)) & 1 if self.low else np.zeros((len(wanted), 0), np.uint8)
        return ((places - wanted) << self.low) | (bits.astype(np.int64) << np.arange(self.low)).sum(axis=1)

    def all(self) -> np.ndarray:
        """Every value."""
        if not self.n:
            return np.zeros(0, dtype=np.int64)
        high = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.lows, bitorder="little")[: self.n * self.low].reshape(self.n, self.low)
        lows = (bits.astype(np.int64) << np.arange(self.low)).sum(axis=1) if self.low else 0
        return (high.astype(np.int64) << self.low) | lows
