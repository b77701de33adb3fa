"""Elias-Fano code of a sequence of numbers that never falls.

Each number is split into ``low`` bits, stored packed, and the rest, stored as a one at position
``high + index`` of a bit string. ``n`` numbers below ``u`` take about ``2 + log2(u / n)`` bits each.
A directory holds the position of every STRIDE-th one, so that a single number is found without
decoding the others; its entries have 32 bits unless the bit string is longer than that.
"""

from __future__ import annotations

import struct

import numpy as np

STRIDE = 256
_HEAD = struct.Struct("<QQBBxx4xQQ")  # numbers, largest, low bits, bytes of a directory entry, bytes of low, bytes of high
_ONES = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def encode(values: np.ndarray) -> bytes:
    values = np.asarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0, 4, 0, 0)
    if n > 1 and (values[1:] < values[:-1]).any():
        raise ValueError("the numbers fall")
    largest = int(values[-1])
    low = max(0, (largest // n).bit_length() - 1)
    at = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(at[-1]) + 1, np.uint8)
    bits[at] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    lows = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    packed = np.packbits(lows.reshape(-1), bitorder="little").tobytes()
    entry = 4 if int(at[-1]) < 1 << 32 else 8
    return _HEAD.pack(n, largest, low, entry, len(packed), len(high)) + packed + high + at[::STRIDE].astype(f"<u{entry}").tobytes()


class EliasFano:
    def __init__(self, code: bytes):
        self.n, self.largest, self.low, entry, n_low, n_high = _HEAD.unpack_from(code)
        at = _HEAD.size
        self.lows = np.frombuffer(code, np.uint8, n_low, at)
        self.high = np.frombuffer(code, np.uint8, n_high, at + n_low)
        self.directory = np.frombuffer(code, f"<u{entry}", -(-self.n // STRIDE), at + n_low + n_high)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The number at index ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        byte, bit = divmod(int(self.directory[i // STRIDE]), 8)
        left = i % STRIDE + bin(int(self.high[byte]) & ((1 << bit) - 1)).count("1")
        # Byte by byte, in stretches, to the one that is wanted.
        while True:
            ones = np.cumsum(_ONES[self.high[byte : byte + 64]])
            if ones[-1] > left:
                break
            left -= int(ones[-1])
            byte += 64
        k = int(np.searchsorted(ones, left, side="right"))
        left -= int(ones[k - 1]) if k else 0
        place = int(np.flatnonzero(np.unpackbits(self.high[byte + k : byte + k + 1], bitorder="little"))[left])
        high = (byte + k) * 8 + place - i
        first, last = i * self.low, (i + 1) * self.low
        window = int.from_bytes(self.lows[first // 8 : -(-last // 8)].tobytes(), "little")
        return (high << self.low) | ((window >> (first % 8)) & ((1 << self.low) - 1))

    def run(self, first: int, last: int) -> np.ndarray:
        """The numbers at indices ``first`` to ``last``; only the bits between their directory entries are decoded."""
        if last <= first:
            return np.empty(0, np.uint64)
        begin, after = int(self.directory[first // STRIDE]), (last - 1) // STRIDE + 1
        end = int(self.directory[after]) if after < len(self.directory) else 8 * len(self.high)
        byte = begin // 8
        at = np.flatnonzero(np.unpackbits(self.high[byte : -(-end // 8)], bitorder="little")[begin - 8 * byte :]) + begin
        high = (at[first % STRIDE :][: last - first] - np.arange(first, last)).astype(np.uint64)
        bit = first * self.low
        lows = np.unpackbits(self.lows[bit // 8 : -(-last * self.low // 8)], bitorder="little")[bit % 8 :][: (last - first) * self.low]
        lows = lows.reshape(last - first, self.low).astype(np.uint64)
        return (high << np.uint64(self.low)) | (lows << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def values(self) -> np.ndarray:
        """All numbers."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (at - np.arange(self.n)).astype(np.uint64)
        lows = np.unpackbits(self.lows, bitorder="little")[: self.n * self.low].reshape(self.n, self.low).astype(np.uint64)
        return (high << np.uint64(self.low)) | (lows << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def locate(self, value: int) -> int:
        """The index of the last number that is at most ``value``; -1 where there is none."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            if self.select(mid) <= value:
                lo = mid + 1
            else:
                hi = mid
        return lo - 1
