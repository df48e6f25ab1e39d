"""Elias-Fano coding of a non-decreasing sequence of non-negative integers.

n values up to u take about n * (2 + log2(u / n)) bits: the low bits of each
value are packed, the high parts are a bit vector with a one per value at
position high + index. Every ``SAMPLE``-th one's position is kept (uint32,
relative to its superblock), so ``select`` scans a few bytes.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QBQQ")  # n, low bits, bytes of low bits, bytes of high bits
#: For each byte: the position of its k-th one.
_PLACE = np.zeros((256, 8), dtype=np.int64)
for _b in range(256):
    _ones = [i for i in range(8) if _b >> i & 1]
    _PLACE[_b, :len(_ones)] = _ones
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        high_part = (values >> np.uint64(low_bits)).astype(np.int64)
        ones = high_part + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[ones] = 1
        if low_bits:
            shifts = np.arange(low_bits, dtype=np.uint64)
            low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, dtype=np.uint8)
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """Value ``i``, by the sampled position and a scan of fewer than SAMPLE ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, rest = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        count = -int(_POPCOUNT[self.high[byte] & ((1 << (at & 7)) - 1)])  # ones of this byte before the sample
        while count + int(_POPCOUNT[self.high[byte]]) <= rest:
            count += int(_POPCOUNT[self.high[byte]])
            byte += 1
        value = int(self.high[byte])
        for bit in range(8):
            if value >> bit & 1:
                if count == rest:
                    return ((byte * 8 + bit - i) << self.low_bits) | self._low(i)
                count += 1
        raise AssertionError("samples do not match the bit vector")

    def select_many(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``, each from its sampled position on, all side by side."""
        index = np.asarray(index, dtype=np.int64)
        if len(index) and not 0 <= index.min() <= index.max() < self.n:
            raise IndexError("select beyond the sequence")
        at = self.samples[index // SAMPLE].astype(np.int64)
        byte = at >> 3
        # ones to pass from the beginning of the sample's byte
        left = index % SAMPLE + _POPCOUNT[self.high[byte] & ((1 << (at & 7)) - 1)]
        going = np.arange(len(index))
        while len(going):
            ones = _POPCOUNT[self.high[byte[going]]]
            further = left[going] >= ones
            going, ones = going[further], ones[further]
            left[going] -= ones
            byte[going] += 1
        high = 8 * byte + _PLACE[self.high[byte], left] - index
        return (high << self.low_bits) | self._lows(index)

    def _lows(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), dtype=np.int64)
        first = index * self.low_bits
        padded = np.concatenate((self.low, np.zeros(9, dtype=np.uint8))).astype(np.uint64)
        out = np.zeros(len(index), dtype=np.uint64)
        shift = (first & 7).astype(np.uint64)
        for k in range((self.low_bits + 14) // 8):  # the bytes that one value's bits can touch
            part = padded[(first >> 3) + k]
            out |= (part << np.uint64(8 * k)) >> shift if k < 8 else part << (np.uint64(64) - shift)
        return (out & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        chunk = int.from_bytes(self.low[first >> 3:(last + 7) >> 3].tobytes(), "little")
        return chunk >> (first & 7) & ((1 << self.low_bits) - 1)

    def decode(self) -> np.ndarray:
        """All values, as int64."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        high = ones - np.arange(self.n)
        if not self.low_bits:
            return high.astype(np.int64)
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return (high.astype(np.int64) << self.low_bits) | low

    def to_bytes(self) -> bytes:
        return b"".join((_HEAD.pack(self.n, self.low_bits, len(self.low), len(self.high)),
                         self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()))

    @classmethod
    def from_bytes(cls, data: memoryview, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that begins at byte ``at``, and where it ends."""
        n, low_bits, n_low, n_high = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        n_samples = -(-n // SAMPLE)
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(data, "<u4", n_samples, at + n_low + n_high)
        return cls(n, low_bits, low, high, samples), at + n_low + n_high + 4 * n_samples
