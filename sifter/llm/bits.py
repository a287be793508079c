"""Large bit filters: set by tasks, merged segment by segment, mapped into memory by workers.

A filter has at most MAX_BITS bits, so what passes the driver and what workers map is
bounded. A filter that is too small for its keys only lets more candidates through; the
operators confirm every candidate exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sifter.llm.files import local, ship_bytes

#: Bits of a segment, the unit that one reducer merges, and of a whole filter (64 MB).
SEGMENT_BITS = 20
MAX_BITS = 29


def filter_bits(keys: int, per_key: int = 16) -> int:
    """log2 of the bits of a filter for so many keys."""
    return min(MAX_BITS, max(SEGMENT_BITS, int(keys * per_key).bit_length()))


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each 64-bit hash in a filter of 2**bits bits."""
    mixed = (hashes ^ hashes >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), (mixed >> np.uint64(64 - bits)).astype(np.int64)


def pack_segment(at: np.ndarray) -> bytes:
    """Sorted places inside a segment: listed while that is shorter, else as bits."""
    if 4 * len(at) < 1 << (SEGMENT_BITS - 3):
        return b"\0" + at.astype("<u4").tobytes()
    flags = np.zeros(1 << SEGMENT_BITS, bool)
    flags[at] = True
    return b"\1" + np.packbits(flags, bitorder="little").tobytes()


def unpack_segment(data: bytes) -> np.ndarray:
    """The flags of a segment."""
    if data[0]:
        return np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little").view(bool)
    flags = np.zeros(1 << SEGMENT_BITS, bool)
    flags[np.frombuffer(data, "<u4", offset=1)] = True
    return flags


def set_bits(data: np.ndarray, at: np.ndarray) -> None:
    """Set the bits ``at`` of a packed array."""
    at = np.unique(at)
    of = at >> 3
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(at) else np.zeros(0, np.int64)
    if len(first):
        data[of[first]] |= np.bitwise_or.reduceat(np.uint8(1) << (at & 7).astype(np.uint8), first)


def get_bits(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the bits ``at`` of a packed array are set."""
    return (data[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) != 0


def set_places(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(segment, sorted places in it) of a packed array, segments without any left out."""
    size = 1 << (SEGMENT_BITS - 3)
    for segment in range(len(data) // size):
        part = data[segment * size: (segment + 1) * size]
        if part.any():
            yield segment, np.flatnonzero(np.unpackbits(part, bitorder="little"))


def rows_by_key(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """(value of the first column, other columns' values) row by row, a batch at a time."""
    for batch in batches:
        keys = batch.column(0).to_pylist()
        for k, key in enumerate(keys):
            yield key, [batch.column(c)[k].as_py() for c in range(1, batch.num_columns)]


def key_filter(df: DataFrame, bits: int) -> DataFrame:
    """(segment, flags) of a filter of the longs in ``df``'s only column."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            for at in places(batch.column(0).to_numpy().view(np.uint64), bits):
                set_bits(data, at)
        for segment, at in set_places(data):
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([pack_segment(at)], pa.binary())], ["segment", "part"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, flags = None, None
        for segment, (part,) in rows_by_key(batches):
            if segment != now:
                if now is not None:
                    yield flag_row(now, flags)
                now, flags = segment, unpack_segment(part)
            else:
                flags |= unpack_segment(part)
        if now is not None:
            yield flag_row(now, flags)

    parts = df.mapInArrow(scan, "segment int, part binary")
    return parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, FLAGS)


FLAGS = "segment int, flags binary"


def flag_row(segment: int, flags: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], ["segment", "flags"])


def ship_filter(merged: DataFrame, bits: int) -> str:
    """Fetch (segment int, flags binary) rows one by one, at most 2**(bits - SEGMENT_BITS) of
    them, and hand the filter to all executors; returns its name for ``Filter``."""
    data = bytearray(1 << (bits - 3))
    size = 1 << (SEGMENT_BITS - 3)
    for segment, flags in merged.toLocalIterator():
        data[segment * size: (segment + 1) * size] = flags
    return ship_bytes(merged.sparkSession, bytes(data), "filter")


class Filter:
    """A shipped filter, mapped into memory."""

    def __init__(self, name: str, bits: int):
        self.data, self.bits = np.memmap(local(name), np.uint8, "r"), bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes have both their bits set."""
        one, two = places(hashes, self.bits)
        return get_bits(self.data, one) & get_bits(self.data, two)
