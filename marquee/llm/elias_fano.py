"""Ascending whole numbers in Elias-Fano form.

Each number is split: the low bits are stored as they are, the high parts as a
bit vector in which the ``i``-th one stands at ``high + i``. That takes at most
two bits a number besides the low ones. ``select`` finds the place of the
``i``-th one from a sample of every 256th place and a scan of the few bytes
after it, so that any number can be had without unpacking the others and without
a table of 64-bit offsets.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = struct.Struct("<QQBQQ")  # count, largest number, low bits, bytes of low part, bytes of high part
ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def encode(values: np.ndarray) -> bytes:
    """``values`` must be ascending (equal ones allowed) and not negative."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    largest = int(values[-1]) if n else 0
    low = max(0, ((largest + 1) // max(n, 1)).bit_length() - 1)
    high = (values >> np.uint64(low)).astype(np.int64)
    places = high + np.arange(n)
    bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    bits[places] = 1
    packed_high = np.packbits(bits, bitorder="little").tobytes()
    packed_low = b""
    if low and n:
        planes = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        packed_low = np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()
    # The bit vector has under 3 bits a number, so 32-bit samples serve up to 10^9 numbers in one block.
    samples = places[::SAMPLE].astype("<u4").tobytes()
    return HEAD.pack(n, largest, low, len(packed_low), len(packed_high)) + packed_low + packed_high + samples


class EliasFano:
    """Reads an encoded block out of a buffer."""

    def __init__(self, data: bytes, at: int = 0):
        self.n, self.largest, self.low, n_low, n_high = HEAD.unpack_from(data, at)
        at += HEAD.size
        self.low_bytes = np.frombuffer(data, np.uint8, n_low, at)
        self.high_bytes = np.frombuffer(data, np.uint8, n_high, at + n_low)
        n_samples = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u4", n_samples, at + n_low + n_high)
        self.end = at + n_low + n_high + 4 * n_samples

    def select(self, i: int) -> int:
        """Place of the ``i``-th one in the high part."""
        place = int(self.samples[i // SAMPLE])
        rest = i % SAMPLE
        byte, skip = divmod(place, 8)
        current = int(self.high_bytes[byte]) >> skip << skip
        while rest >= ONES[current]:
            rest -= int(ONES[current])
            byte += 1
            current = int(self.high_bytes[byte])
        for _ in range(rest):
            current &= current - 1
        return 8 * byte + (current & -current).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = i * self.low
        value = 0
        if self.low:
            window = self.low_bytes[start // 8 : (start + self.low + 7) // 8].tobytes()
            value = int.from_bytes(window, "little") >> start % 8 & (1 << self.low) - 1
        return (self.select(i) - i) << self.low | value

    def all(self) -> np.ndarray:
        """All numbers, unpacked in one go."""
        places = np.flatnonzero(np.unpackbits(self.high_bytes, bitorder="little")).astype(np.int64)[: self.n]
        values = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if self.low and self.n:
            planes = np.unpackbits(self.low_bytes, count=self.n * self.low, bitorder="little")
            weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
            values |= (planes.reshape(self.n, self.low).astype(np.uint64) * weights).sum(1, dtype=np.uint64)
        return values
