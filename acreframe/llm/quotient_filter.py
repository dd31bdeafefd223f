"""Counting quotient filters over packed keys, without loss: a key is permuted invertibly, and its quotient and remainder are kept whole.

A filter holds its keys in the order of their permuted values.  The high bits (the quotient) are told by two bit vectors, which quotients
occur and which key is the last of its quotient; the low bits (the remainder) are kept in full, with a byte that counts, and beyond 254 a long.
Since filters are sorted alike, those of several shards are merged by value, their counters added.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np

#: Fixed odd multipliers of the permutation; any odd number can be inverted.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_HEADER = struct.Struct("<QBB")
_FULL = 255


def permute(keys: np.ndarray, bits: int) -> np.ndarray:
    """Mixes keys of `bits` bits; no two of them to the same value."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    x = keys.astype(np.uint64)
    for odd in _ODD:
        x = (x ^ x >> half) * np.uint64(odd) & mask
    return x ^ x >> half


def restore(values: np.ndarray, bits: int) -> np.ndarray:
    """The keys that permute() made the values of."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    x = values ^ values >> half  # a shift by half of the bits at least is its own inverse
    for odd in reversed(_ODD):
        x = x * np.uint64(pow(odd, -1, 1 << 64)) & mask
        x ^= x >> half
    return x


class Counted(NamedTuple):
    """Sorted distinct values and how often each occurs."""

    values: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> Counted:
        values, counts = np.unique(values, return_counts=True)
        return cls(values, counts.astype(np.int64))

    def merged(self, *others: Counted) -> Counted:
        """One filter of several: counters of equal values are added."""
        values, counts = (np.concatenate([x[i] for x in (self, *others)]) for i in range(2))
        order = np.argsort(values, kind="stable")  # runs that are sorted already are merged, not sorted anew
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])[: len(values) + 1])) if len(values) else np.zeros(0, np.int64)
        return Counted(values[first], np.add.reduceat(counts, first) if len(first) else counts)


def encode(held: Counted, width: int) -> bytes:
    """The filter of values of `width` bits as bytes."""
    n = len(held.values)
    quotient_bits = min(width, max(n - 1, 0).bit_length())
    rest = width - quotient_bits
    quotient = (held.values >> np.uint64(rest)).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotient] = True
    last = np.ones(n, bool)
    last[:-1] = quotient[1:] != quotient[:-1]
    remainders = (held.values & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, : (rest + 7) // 8]
    counters = np.minimum(held.counts, _FULL).astype(np.uint8)
    large = held.counts[held.counts >= _FULL].astype("<i8")
    return b"".join([_HEADER.pack(n, quotient_bits, width), np.packbits(occupied).tobytes(), np.packbits(last).tobytes(), remainders.tobytes(), counters.tobytes(), large.tobytes()])


def decode(blob: bytes) -> Counted:
    """What encode() has put into bytes."""
    n, quotient_bits, width = _HEADER.unpack_from(blob)
    rest, at, parts = width - quotient_bits, _HEADER.size, []
    size = (rest + 7) // 8
    for many in (-(-(1 << quotient_bits) // 8), -(-n // 8), n * size, n):
        parts.append(np.frombuffer(blob, np.uint8, many, at))
        at += many
    occupied = np.flatnonzero(np.unpackbits(parts[0], count=1 << quotient_bits))
    last = np.unpackbits(parts[1], count=n)
    remainders = np.zeros((n, 8), np.uint8)
    remainders[:, :size] = parts[2].reshape(n, size)
    quotient = occupied[np.cumsum(last) - last].astype(np.uint64)
    counts = parts[3].astype(np.int64)
    counts[counts == _FULL] = np.frombuffer(blob, "<i8", -1, at)
    return Counted(quotient << np.uint64(rest) | remainders.view("<u8").reshape(n), counts)
