"""F1 for passages: maximal matching word runs between two texts, and fragments chained from them.

Both sides are fingerprinted by winnowing: of every GUARANTEE - GRAM + 1 neighbouring word
grams the one with the smallest hash is kept, with its place. A run of GUARANTEE or more
equal words therefore shares a kept gram at the same distance from its ends on both sides.
Shared grams (seeds) come from one equi-join and name diagonals; along a diagonal the words
are compared, which gives every maximal run with its start and end on each side. The score
does not fall with the length of the document. A chain of runs that ascend on both sides
makes a fragment with gaps.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.operators.common import bounded_broadcast
from sifter.params import Params
from sifter.session import ensure_workers

#: Words of a gram, and of the shortest run that is found for certain and reported.
GRAM, GUARANTEE = 5, 8

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def winnowed(keys: np.ndarray, gram: int = GRAM, guarantee: int = GUARANTEE) -> tuple[np.ndarray, np.ndarray]:
    """(gram hash, place) of the kept grams of a text's word hashes."""
    n = len(keys) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    for k in range(gram):
        value = value * _MULTIPLIER + keys[k: k + n]
    value ^= value >> np.uint64(31)
    value *= _MULTIPLIER
    width = min(guarantee - gram + 1, n)
    windows = np.lib.stride_tricks.sliding_window_view(value, width)
    at = np.unique(np.arange(len(windows)) + np.argmin(windows, axis=1))
    return value[at], at


def fingerprints(df: DataFrame, key: str, gram: int = GRAM, guarantee: int = GUARANTEE) -> DataFrame:
    """(key, hash, place) of the kept grams of ``df`` (key, keys array<bigint>)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            at = lists.offsets.to_numpy()
            values = lists.values.to_numpy().view(np.uint64)
            for k in range(batch.num_rows):
                hashes, place = winnowed(values[at[k]: at[k + 1]], gram, guarantee)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(place), k))), pa.array(hashes.view(np.int64)), pa.array(place.astype(np.int32))],
                                                 [key, "hash", "place"])

    return df.select(key, "keys").mapInArrow(run, f"`{key}` {kind}, hash bigint, place int")


def matching_runs(left: DataFrame, right: DataFrame, left_key: str, right_key: str, params: Params, text: str = "text",
                  gram: int = GRAM, guarantee: int = GUARANTEE) -> DataFrame:
    """(left_key, right_key, left_start, left_end, right_start, right_end) in words, ends
    exclusive: every maximal run of ``guarantee`` or more equal words between a left and a
    right text. Keys are unique on their side; null keys and null texts match nothing."""
    ensure_workers(left.sparkSession)
    a, b = (df.where(F.col(k).isNotNull() & F.col(text).isNotNull()).select(k, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("keys"))
            for df, k in ((left, left_key), (right, right_key)))
    ours, _ = bounded_broadcast(fingerprints(a, left_key, gram, guarantee).withColumnRenamed("place", "_at"), params.broadcast_max_rows)
    seeds = fingerprints(b, right_key, gram, guarantee).join(ours, "hash")
    diagonals = seeds.select(left_key, right_key, (F.col("place") - F.col("_at")).alias("shift")).distinct()
    # along a diagonal only the part of the right text that lies beside the left one is needed
    both = diagonals.join(a.withColumnRenamed("keys", "_a"), left_key).join(b.withColumnRenamed("keys", "_b"), right_key)
    beside = both.select(left_key, right_key, "shift", "_a", F.greatest(F.lit(0), -F.col("shift")).alias("_from"),
                         F.expr("slice(_b, greatest(shift, 0) + 1, size(_a))").alias("_part"))
    stops = F.expr("""filter(sequence(_from - 1, least(size(_a), _from + size(_part))),
                             i -> i < _from or i >= least(size(_a), _from + size(_part)) or _a[i] <> _part[i - _from])""")
    runs = beside.select(left_key, right_key, "shift", stops.alias("_stops")).select(left_key, right_key, "shift", F.explode(F.expr(
        f"filter(transform(sequence(1, size(_stops) - 1), j -> struct(_stops[j - 1] + 1 as low, _stops[j] as high)), r -> r.high - r.low >= {guarantee})")).alias("r"))
    return runs.select(left_key, right_key, F.col("r.low").alias("left_start"), F.col("r.high").alias("left_end"),
                       (F.col("r.low") + F.col("shift")).alias("right_start"), (F.col("r.high") + F.col("shift")).alias("right_end"))


def best_chain(runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The runs (left start, left end, right start, right end) that follow each other on both
    sides without overlap and have the most words; ties go to the chain that ends first."""
    runs = sorted(runs, key=lambda r: (r[1], r[3], r[0], r[2]))
    total, before = [0] * len(runs), [-1] * len(runs)
    ends: list[int] = []  # right ends of open chains, ascending, and
    best: list[tuple[int, int]] = []  # the words and last run of the best chain that ends there or earlier
    waiting, done = sorted(range(len(runs)), key=lambda k: runs[k][0]), 0
    order = list(range(len(runs)))
    for k in waiting:  # by left start; chains that end before it on the left are open
        while done < len(order) and runs[order[done]][1] <= runs[k][0]:
            i = order[done]
            done += 1
            at = bisect_left(ends, runs[i][3])
            if at < len(ends) and ends[at] == runs[i][3]:
                if best[at][0] >= total[i]:
                    continue
            elif at and best[at - 1][0] >= total[i]:
                continue
            else:
                ends.insert(at, runs[i][3])
                best.insert(at, (0, -1))
            best[at] = (total[i], i)
            while at + 1 < len(ends) and best[at + 1][0] <= total[i]:
                del ends[at + 1], best[at + 1]
        at = bisect_left(ends, runs[k][2] + 1)
        total[k] = runs[k][1] - runs[k][0] + (best[at - 1][0] if at else 0)
        before[k] = best[at - 1][1] if at else -1
    chain, k = [], max(range(len(runs)), key=lambda i: (total[i], -i), default=-1)
    while k >= 0:
        chain.append(runs[k])
        k = before[k]
    return chain[::-1]


def chained_fragments(runs: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row a pair with a run: the extents of its best chain on both sides, the number of
    runs in it and the words they match. A pair's runs are a short list beside its texts."""
    ensure_workers(runs.sparkSession)
    fields = ("left_start", "left_end", "right_start", "right_end")
    lists = runs.groupBy(left_key, right_key).agg(F.collect_list(F.struct(*fields)).alias("runs"))
    kinds = ", ".join(f"`{k}` {lists.schema[k].dataType.simpleString()}" for k in (left_key, right_key))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column(2).to_pylist():
                chain = best_chain([tuple(r[f] for f in fields) for r in row])
                out.append((chain[0][0], chain[-1][1], chain[0][2], chain[-1][3], len(chain), sum(r[1] - r[0] for r in chain)))
            columns = [pa.array(c, pa.int32()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int32())] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], [left_key, right_key, *fields, "n_runs", "n_words"])

    return lists.mapInArrow(run, f"{kinds}, " + ", ".join(f"{f} int" for f in (*fields, "n_runs", "n_words")))
