"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.operators.common import shared_path, written  # noqa: F401
from sifter.session import ARROW_BYTES, ARROW_ROWS, ensure_workers  # noqa: F401

#: Bytes of texts that a task works on at once.
BLOCK_BYTES = 1 << 20

T = TypeVar("T")


def prepare(spark: SparkSession) -> None:
    """Make the package importable in the workers and keep Arrow batches small, by rows and by
    bytes (a batch has one row at least)."""
    ensure_workers(spark)


_HELD: dict = {}


def held(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept by the worker process for later tasks with the same key; a
    worker keeps one such object, so those of other stages go first."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Drop what earlier stages left in this worker, and return free Arrow memory."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()


def array_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) runs of at most about ``limit`` bytes, at least one row each."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
    start = 0
    while start < len(sizes):
        stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), limit)))
        yield start, texts.slice(start, stop - start)
        start = stop


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """The same as strings; a null text comes as the empty one."""
    for start, some in array_blocks(texts, limit):
        yield start, [t if t is not None else "" for t in some.to_pylist()]


def byte_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The same as UTF-8 bytes."""
    for start, some in array_blocks(texts.cast(pa.binary()), limit):
        yield start, [t if t is not None else b"" for t in some.to_pylist()]


#: A key with more than this share of all rows is joined by broadcast; there are fewer of them.
HOT = 4096


def hot_join(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join with a table of distinct keys that knows the number of rows of each in
    ``weight``. Fewer than HOT keys have more than their share of the rows: they are
    broadcast, so no task gets a hot key's rows; all others are joined by shuffle. ``rows``
    should be a written table, as both ways read it."""
    least = (table.agg(F.sum(weight)).first()[0] or 0) / HOT
    hot, cold = F.broadcast(table.where(F.col(weight) > least)), table.where(F.col(weight) <= least)
    return rows.join(hot, key).unionByName(rows.join(F.broadcast(table.where(F.col(weight) > least).select(key)), key, "left_anti").join(cold, key))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[0], starts[0]+1, ..., starts[1], ... of consecutive runs."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
