"""Rising whole numbers in near-minimal space, with select.

Of each of n numbers below u the low log2(u / n) bits are stored as they are; the rest is a bit vector with
one set bit per number and one clear bit per step of the upper part: 2 + log2(u / n) bits a number.
The place of every 64th set bit is kept in 32 bits, so a number is found without reading what comes
before it.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

SAMPLE = 64
HEADER = struct.Struct("<QQB")


@dataclass(frozen=True)
class EliasFano:
    count: int
    low_bits: int
    lows: np.ndarray
    highs: np.ndarray
    samples: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """``values`` must not fall; equal ones may follow each other."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if n and (values[1:] < values[:-1]).any():
            raise ValueError("the numbers fall")
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n) if n else np.zeros(0, np.int64)
        if n and ones[-1] >= 1 << 32:
            raise ValueError("too many numbers for one vector; write more parts")
        vector = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        vector[ones] = 1
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        return cls(n, bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little"), np.packbits(vector, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def _ones(self, start: int, count: int) -> np.ndarray:
        """Places of the set bits number start .. start+count-1."""
        skip = start % SAMPLE
        place = int(self.samples[start // SAMPLE])
        byte, found, parts = place // 8, 0, []
        while found < skip + count:
            bits = np.unpackbits(self.highs[byte : byte + max(64, count // 2)], bitorder="little")
            ones = np.flatnonzero(bits) + byte * 8
            ones = ones[ones >= place]
            parts.append(ones)
            found += len(ones)
            byte += max(64, count // 2)
        return np.concatenate(parts)[skip : skip + count]

    def run(self, start: int, count: int) -> np.ndarray:
        """Numbers start .. start+count-1."""
        count = min(count, self.count - start)
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        upper = (self._ones(start, count) - np.arange(start, start + count)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return upper
        first, last = start * self.low_bits, (start + count) * self.low_bits
        bits = np.unpackbits(self.lows[first // 8 : -(-last // 8)], bitorder="little")[first % 8 :][: last - first]
        return upper | (bits.reshape(count, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        return int(self.run(i, 1)[0])

    def to_bytes(self) -> bytes:
        return HEADER.pack(self.count, len(self.highs), self.low_bits) + self.samples.astype("<u4").tobytes() + self.highs.tobytes() + self.lows.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[EliasFano, bytes]:
        """The numbers, and what follows them."""
        count, high_bytes, bits = HEADER.unpack_from(data)
        at = HEADER.size
        samples = np.frombuffer(data, "<u4", -(-count // SAMPLE), at)
        at += samples.nbytes
        highs = np.frombuffer(data, np.uint8, high_bytes, at)
        at += high_bytes
        lows = np.frombuffer(data, np.uint8, -(-count * bits // 8), at)
        return cls(count, bits, lows, highs, samples), data[at + lows.nbytes :]
