"""Counting quotient filters over n-grams of word numbers, without loss.

An n-gram is packed into two halves and permuted by an invertible Feistel network. The top
bits of the result are the quotient (a slot), all other bits the remainder, so a filter holds
its keys in full: counts are exact and keys can be restored. Entries are sorted, so filters
of different shards merge like sorted runs. Packed, a filter has a bit per slot (occupied), a
bit per entry (end of run), the remainders in whole bytes and counters of one byte, with
larger ones listed apart.
"""

from __future__ import annotations

import struct

import numpy as np

_ROUNDS = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _mix(x: np.ndarray, c: np.uint64) -> np.ndarray:
    x = (x + c) * _ROUNDS[0]
    x ^= x >> np.uint64(29)
    x *= _ROUNDS[2]
    return x ^ x >> np.uint64(32)


class Layout:
    """Places of the bits of n-grams with ``n`` word numbers of ``bits`` bits (3 * bits at most 63)."""

    def __init__(self, n: int, bits: int):
        self.n, self.bits, self.half = n, bits, (n + 1) // 2 * bits
        if self.half > 63:
            raise ValueError("word numbers are too wide")
        self.top, self.low = min(64, 2 * self.half), max(0, 2 * self.half - 64)

    def pack(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray | None]:
        """Permuted keys (top, low) of the n-grams whose k-th words are ``words[k]``."""
        halves = []
        for part in (words[: (self.n + 1) // 2], words[(self.n + 1) // 2:]):
            value = part[0].astype(np.uint64)
            for w in part[1:]:
                value = value << np.uint64(self.bits) | w.astype(np.uint64)
            halves.append(value)
        left, right = halves
        for c in _ROUNDS:
            left, right = right, left ^ _mix(right, c) & _mask(self.half)
        if not self.low:
            return left << np.uint64(self.half) | right, None
        return left << np.uint64(64 - self.half) | right >> np.uint64(self.low), right & _mask(self.low)

    def unpack(self, top: np.ndarray, low: np.ndarray | None) -> list[np.ndarray]:
        """The words of permuted keys."""
        if low is None:
            left, right = top >> np.uint64(self.half), top & _mask(self.half)
        else:
            left = top >> np.uint64(64 - self.half)
            right = (top & _mask(64 - self.half)) << np.uint64(self.low) | low
        for c in reversed(_ROUNDS):
            left, right = right ^ _mix(left, c) & _mask(self.half), left
        words = []
        for value, count in ((left, (self.n + 1) // 2), (right, self.n // 2)):
            words += [value >> np.uint64(self.bits * k) & _mask(self.bits) for k in reversed(range(count))]
        return words

    def hashes(self, top: np.ndarray, low: np.ndarray | None) -> np.ndarray:
        """64-bit hashes of keys, for bit filters."""
        return _mix(top if low is None else top ^ low * _ROUNDS[1], _ROUNDS[3])


def counted(top: np.ndarray, low: np.ndarray | None, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Distinct keys in ascending order with the sums of their counts (each 1 without counts)."""
    if low is None and counts is None:
        top = np.sort(top)
    else:
        order = np.argsort(top, kind="stable")
        if low is not None and len(top) > 1:
            a, b = top[order], low[order]
            if ((a[1:] == a[:-1]) & (b[1:] < b[:-1])).any():
                order = np.lexsort((low, top))
        top, low = top[order], None if low is None else low[order]
        counts = None if counts is None else counts[order]
    new = np.ones(len(top), bool)
    new[1:] = top[1:] != top[:-1]
    if low is not None:
        new[1:] |= low[1:] != low[:-1]
    first = np.flatnonzero(new)
    sums = np.diff(np.append(first, len(top))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts
    return top[first], None if low is None else low[first], sums.astype(np.int64)


def _to_bytes(values: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8]).tobytes()


def _from_bytes(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, memoryview]:
    size = (bits + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size).reshape(n, size)
    return out.view("<u8").ravel().astype(np.uint64), data[n * size:]


def pack_filter(layout: Layout, skip: int, top: np.ndarray, low: np.ndarray | None, counts: np.ndarray) -> bytes:
    """The filter of sorted distinct keys that share their first ``skip`` bits."""
    n = len(top)
    q = min(layout.top - skip, n.bit_length())
    rest = layout.top - skip - q
    quotient = top >> np.uint64(rest) & _mask(q) if rest < 64 else np.zeros(n, np.uint64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient.astype(np.int64)] = True
    ends = np.ones(n, bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    small, large = np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255]
    return b"".join((struct.pack("<IBI", n, q, len(large)), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), _to_bytes(top & _mask(rest), rest),
                     b"" if low is None else _to_bytes(low, layout.low), small.tobytes(), large.astype("<u8").tobytes()))


def unpack_filter(layout: Layout, skip: int, prefix: int, data: bytes) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Sorted keys and counts of a packed filter whose keys begin with ``prefix``."""
    n, q, large = struct.unpack_from("<IBI", data)
    rest, view = layout.top - skip - q, memoryview(data)[struct.calcsize("<IBI"):]
    size = ((1 << q) + 7) // 8
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(view, np.uint8, size), count=1 << q))
    view = view[size:]
    size = (n + 7) // 8
    ends = np.unpackbits(np.frombuffer(view, np.uint8, size), count=n).astype(np.int64)
    view = view[size:]
    quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64)
    top, view = _from_bytes(view, n, rest)
    if rest < 64:
        top |= quotient << np.uint64(rest)
    if skip:
        top |= np.uint64(prefix << (layout.top - skip))
    low = None
    if layout.low:
        low, view = _from_bytes(view, n, layout.low)
    counts = np.frombuffer(view, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(view, "<u8", large, offset=n).astype(np.int64)
    return top, low, counts


def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """One filter's keys and counts from several."""
    if len(parts) == 1:
        return parts[0]
    low = None if parts[0][1] is None else np.concatenate([p[1] for p in parts])
    return counted(np.concatenate([p[0] for p in parts]), low, np.concatenate([p[2] for p in parts]))
