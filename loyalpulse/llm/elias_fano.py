"""Elias-Fano code of a non-decreasing sequence, with select.

Of ``n`` values up to ``u`` the lowest ``log2(u / n)`` bits are packed one after the other;
the rest is a bit vector in unary, two bits a value.  Every ``EVERY``-th one of the vector
is noted as a 32-bit place, from which select counts on, so a value is found without a
table of 64-bit offsets: about ``2 + log2(u / n)`` bits a value in all.
"""

from __future__ import annotations

import struct

import numpy as np

EVERY = 256
_HEAD = struct.Struct("<QQBxxxxxxx")
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def encode(values: np.ndarray) -> bytes:
    """Bytes of the code; values are non-negative and non-decreasing."""
    values = np.asarray(values, dtype=np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low_bits = max(0, (top // n).bit_length() - 1) if n else 0
    low = values & np.uint64((1 << low_bits) - 1)
    places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    upper = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
    upper[places] = 1
    shifts = np.arange(low_bits, dtype=np.uint64)
    lower = ((low[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    return b"".join(
        (
            _HEAD.pack(n, len(upper), low_bits),
            np.packbits(lower, bitorder="little").tobytes(),
            np.packbits(upper, bitorder="little").tobytes(),
            places[::EVERY].astype("<u4").tobytes(),
        )
    )


class EliasFano:
    """The sequence in ``data``, read at any place."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self._n, bits, self._low_bits = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        lower, upper = (self._n * self._low_bits + 7) // 8, (bits + 7) // 8
        noted = -(-self._n // EVERY)
        self._lower = np.frombuffer(data, np.uint8, lower, at)
        self._upper = np.frombuffer(data, np.uint8, upper, at + lower)
        self._noted = np.frombuffer(data, "<u4", noted, at + lower + upper)
        self.end = at + lower + upper + 4 * noted

    def __len__(self) -> int:
        return self._n

    def _low(self, i: int) -> int:
        first = i * self._low_bits
        last = first + self._low_bits
        part = int.from_bytes(self._lower[first // 8 : -(-last // 8)].tobytes(), "little")
        return part >> (first % 8) & ((1 << self._low_bits) - 1)

    def __getitem__(self, i: int) -> int:
        """Select: the ``i``-th value, from its block's noted place on."""
        if not 0 <= i < self._n:
            raise IndexError(i)
        place, more = int(self._noted[i // EVERY]), i % EVERY
        at = place // 8
        more += int(_ONES[self._upper[at] & ((1 << place % 8) - 1)])
        while True:  # `more` ones to skip from the byte `at` on
            ones = np.cumsum(_ONES[self._upper[at : at + EVERY]])
            hit = int(np.searchsorted(ones, more, "right"))
            if hit < len(ones):
                more -= int(ones[hit - 1]) if hit else 0
                bits = np.flatnonzero(np.unpackbits(self._upper[at + hit : at + hit + 1], bitorder="little"))
                place = 8 * (at + hit) + int(bits[more])
                break
            more -= int(ones[-1])
            at += len(ones)
        return (place - i) << self._low_bits | self._low(i)

    def all(self) -> np.ndarray:
        """All values in order."""
        places = np.flatnonzero(np.unpackbits(self._upper, bitorder="little"))[: self._n]
        high = (places - np.arange(self._n)).astype(np.uint64) << np.uint64(self._low_bits)
        if self._low_bits == 0:
            return high
        bits = np.unpackbits(self._lower, bitorder="little")[: self._n * self._low_bits]
        bits = bits.reshape(self._n, self._low_bits).astype(np.uint64)
        return high | (bits << np.arange(self._low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
