"""SimHash near-duplicates: exact Hamming linking of fingerprints in tiles.

Distinct fingerprints are put into cells by the population counts of their four 16-bit
lanes. Flipping a bit changes one lane count by one, so two fingerprints within the radius
lie in cells whose lane counts differ by at most the radius in all; all other pairs of
tiles are skipped, and no link is lost. The remaining tile pairs are compared in full with
numpy (exclusive-or, bit count).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import prepare, release, text_blocks, written
from sifter.llm.components import components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
LANES = 4
#: Fingerprints per tile: a larger cell is dealt into several tiles.
TILE = 4096


def shingle_hashes(data: bytes, width: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of each run of ``width`` words (repeats included); one hash of all words when
    there are fewer; none for a text without words."""
    words = data.lower().split()
    if not words:
        return []
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True)]


def fingerprint(hashes: list[int]) -> int:
    """Bit k is 1 when it is set in more than half of the hashes; 0 for no hashes."""
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    words = np.array(hashes, np.uint64)
    for i in range(0, len(words), 1 << 15):
        part = words[i: i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(words), bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, keys: list[str], text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``keys`` and the 64-bit ``fp`` (as a signed long) of each row's whole text."""
    prepare(df.sparkSession)
    source = df.select(*keys, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]) + ", fp bigint"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t.encode(), width)) for _, texts in text_blocks(batch.column(batch.num_columns - 1)) for t in texts]
            column = pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*keys, "fp"])

    return source.mapInArrow(run, schema)


def _forest(left: np.ndarray, right: np.ndarray, nodes: int) -> np.ndarray:
    """The root (smallest index) of each of ``nodes`` under the pairs (left, right)."""
    root = np.arange(nodes)
    while True:
        a, b = root[left], root[right]
        open_ = a != b
        if not open_.any():
            return root
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, up := root[root]):
            root = up


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within the radius between two tiles (or inside one): a
    spanning forest, fewer links than fingerprints, however many pairs are close."""
    lefts, rights = [], []
    rows = max(1, (1 << 20) // max(1, len(b)))
    for i in range(0, len(a), rows):
        near = np.bitwise_count(a[i: i + rows, None] ^ b[None, :]) <= radius
        x, y = np.nonzero(near)
        x = x + i
        if same:
            keep = x < y
            x, y = x[keep], y[keep]
        if len(x):
            merged = np.unique(np.concatenate((x, y if same else y + len(a))), return_inverse=True)
            root = _forest(merged[1][: len(x)], merged[1][len(x):], len(merged[0]))
            child = np.flatnonzero(root != np.arange(len(root)))
            lefts.append(merged[0][child])
            rights.append(merged[0][root[child]])
    if not lefts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    nodes = a if same else np.concatenate((a, b))
    left, right = np.concatenate(lefts), np.concatenate(rights)
    root = _forest(left, right, len(nodes))
    child = np.flatnonzero(root != np.arange(len(root)))
    return nodes[child], nodes[root[child]]


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    at, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
    return [values[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]


def hamming_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b) links over the distinct longs ``fp`` that connect exactly what pairs at
    ``radius`` or fewer differing bits connect. The cell table has at most 17**4 rows."""
    prepare(fps.sparkSession)
    bits = 64 // LANES
    lanes = [F.bit_count(F.shiftrightunsigned("fp", bits * k).bitwiseAND(F.lit((1 << bits) - 1))) for k in range(LANES)]
    base = bits + 1
    fps = fps.select("fp", sum((x * base**k for k, x in enumerate(lanes)), F.lit(0)).cast("int").alias("cell"))
    cells = fps.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("parts"))
    tiles = written(fps.join(F.broadcast(cells), "cell")
                    .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
                    .groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")), "tiles")
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=LANES)
             if sum(map(abs, s)) <= radius and s >= (0,) * LANES]
    there = written(tiles.groupBy("cell").agg(F.max("part").alias("last")), "cells")
    lane = [F.floor(F.col("cell") / F.lit(base**k)).cast("int") % base for k in range(LANES)]
    ways = F.array(*[F.struct(*[F.lit(x).alias(f"s{k}") for k, x in enumerate(s)]) for s in steps])
    walks = there.select("cell", *[x.alias(f"l{k}") for k, x in enumerate(lane)], F.explode(ways).alias("s"))
    near = [F.col(f"l{k}") + F.col(f"s.s{k}") for k in range(LANES)]
    for x in near:
        walks = walks.where((x >= 0) & (x <= bits))
    # per cell the at most 65 later cells that exist within the radius, itself included
    pairs = (walks.select("cell", sum((x * base**k for k, x in enumerate(near)), F.lit(0)).cast("int").alias("cell_b"))
             .join(F.broadcast(there.select(F.col("cell").alias("cell_b"), "last")), "cell_b")
             .groupBy("cell").agg(F.collect_list(F.struct("cell_b", "last")).alias("others")))
    left = tiles.join(pairs, "cell").select(
        F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), F.col("fps").alias("fps_a"), F.explode("others").alias("o"))
    first = F.when(F.col("cell_a") == F.col("o.cell_b"), F.col("part_a")).otherwise(F.lit(0))
    left = left.select("cell_a", "part_a", "fps_a", F.col("o.cell_b").alias("cell_b"), F.explode(F.sequence(first, F.col("o.last"))).alias("part_b"))
    right = tiles.select(F.col("cell").alias("cell_b"), F.col("part").alias("part_b"), F.col("fps").alias("fps_b"))
    both = left.join(right, ["cell_b", "part_b"]).select(
        ((F.col("cell_a") == F.col("cell_b")) & (F.col("part_a") == F.col("part_b"))).alias("same"), "fps_a", "fps_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [tile_links(a, b, s, radius) for s, a, b in zip(batch.column(0).to_pylist(), _lists(batch.column(1)), _lists(batch.column(2)), strict=True)]
            if any(len(x) for x, _ in out):
                ends = [np.concatenate([x[k] for x in out]).view(np.int64) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], ["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def simhash_classes(df: DataFrame, keys: list[str], text: str = "text", width: int = SHINGLE_WORDS,
                    radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``keys``, ``fp`` and ``root`` (one long per near-duplicate class) of every row.

    A null or word-less text has fingerprint 0 and links like any other. Repeated rows
    come out repeated. An empty table gives an empty result.
    """
    light = written(with_fingerprint(df, keys, text, width), "fingerprints")
    roots = components(hamming_links(light.select("fp").distinct(), radius, tile))
    return (light.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .select(*keys, "fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable
    over links (null only when the whole class has null ids)."""
    classes = written(simhash_classes(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ["doc_id"], **options), "classes")
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return classes.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each class the row with the smallest
    doc_id (nulls last; among equal ids the smallest text hash) stays, with all its columns."""
    keys = df.select(F.col(doc_id).alias("__id"), F.xxhash64(F.col(text)).alias("__hash"), F.col(text).alias("text"))
    classes = simhash_classes(keys, ["__id", "__hash"], **options)
    first = classes.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("n"), "__id", "__hash")).alias("k"))
    stay = first.select(F.coalesce("k.__id", F.lit(0)).alias("__id"), F.col("k.n").alias("__null"), F.col("k.__hash").alias("__hash"))
    marked = (df.withColumn("__id", F.coalesce(F.col(doc_id).cast("long"), F.lit(0)))
              .withColumn("__null", F.col(doc_id).isNull()).withColumn("__hash", F.xxhash64(F.col(text))))
    return (marked.join(stay, ["__id", "__null", "__hash"], "left_semi")
            .dropDuplicates(["__id", "__null", "__hash"]).drop("__id", "__null", "__hash"))
