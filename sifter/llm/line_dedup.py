"""Line deduplication with two Bloom filters.

Every task keeps a filter of line hashes seen once and one of hashes seen twice. Merging the
tasks' filters segment by segment, a bit that two tasks have in their first filters goes to
the second, so every line that two documents share has its bits in the merged second
filter. Only lines found there are shuffled, as 128-bit cryptographic digests, for an exact
count and the choice of the first document; unique lines never leave their task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.bits import (FLAGS, Filter, filter_bits, flag_row, get_bits, pack_segment, places, rows_by_key, set_bits, set_places,
                             ship_filter, unpack_segment)
from sifter.llm.common import byte_blocks, prepare, written

#: Code points of a key at least.
LEAST = 10
#: A key with more than this share of all suspected rows is joined by broadcast; there are
#: fewer such keys than HOT_SHARE.
HOT_SHARE = 4096


def line_keys(data: bytes, least: int = LEAST) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text and their keys; lines whose key is too short have an empty one."""
    keys = [k.strip() for k in data.lower().split(b"\n")]
    return data.split(b"\n"), [k if len(k) >= least and (len(k) >= 4 * least or len(k.decode()) >= least) else b"" for k in keys]


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _hashes(texts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(hash, text number, key) of each text's distinct keys."""
    found = [list(filter(None, dict.fromkeys(line_keys(t, least)[1]))) for t in texts]
    keys = [k for f in found for k in f]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)), np.repeat(np.arange(len(texts)), [len(f) for f in found]), keys


def twice_seen(docs: DataFrame, bits: int, least: int) -> DataFrame:
    """(segment, flags) of the filter of hashes that more than one text holds."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = (np.zeros(1 << (bits - 3), np.uint8) for _ in range(2))
        for batch in batches:
            for _, texts in byte_blocks(batch.column(0)):
                hashes = np.sort(_hashes(texts, least)[0])
                again = np.concatenate(([False], hashes[1:] == hashes[:-1])) if len(hashes) else np.zeros(0, bool)
                one, two = places(hashes, bits)
                again |= get_bits(once, one) & get_bits(once, two)
                for at in (one, two):
                    set_bits(once, at)
                    set_bits(twice, at[again])
        second = dict(set_places(twice))
        for segment, at in set_places(once):  # what is set twice is also set once
            parts = pack_segment(at), pack_segment(second.get(segment, at[:0]))
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]], ["segment", "once", "twice"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, None, None
        for segment, (a, b) in rows_by_key(batches):
            if segment != now:
                if now is not None:
                    yield flag_row(now, twice)
                now, once, twice = segment, unpack_segment(b"\0"), unpack_segment(b"\0")
            more = unpack_segment(a)
            twice |= once & more
            twice |= unpack_segment(b)
            once |= more
        if now is not None:
            yield flag_row(now, twice)

    scanned = docs.select("text").mapInArrow(scan, "segment int, once binary, twice binary")
    return scanned.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, FLAGS)


def _suspects(docs: DataFrame, kind: str, name: str, bits: int, least: int) -> DataFrame:
    """(doc_id, key digest) of the distinct lines of each text whose bits are in the filter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Filter(name, bits)
        for batch in batches:
            for first, texts in byte_blocks(batch.column(1)):
                hashes, owner, keys = _hashes(texts, least)
                hit = np.flatnonzero(seen.holds(hashes))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + owner[hit])), pa.array([_digest(keys[k]) for k in hit.tolist()], pa.binary())],
                                                 ["doc_id", "key"])

    return docs.mapInArrow(run, f"doc_id {kind}, key binary")


def _strip(docs: DataFrame, kind: str, least: int) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) from the texts and the digests each must lose."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_blocks(batch.column(1)):
                counts, dropped, kept = [], [], []
                for k, data in enumerate(texts):
                    counts.append(data.count(b"\n") + 1)
                    gone = batch.column(2)[first + k]
                    if gone.is_valid:
                        gone = set(gone.as_py())
                        lines, keys = line_keys(data, least)
                        stay = [line for line, key in zip(lines, keys, strict=True) if not key or _digest(key) not in gone]
                        data = b"\n".join(stay)
                        dropped.append(len(lines) - len(stay))
                    else:
                        dropped.append(0)
                    kept.append(data)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()),
                                                  pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    return docs.mapInArrow(run, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept string")


def drop_repeated_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, bits: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped and ``kept``, the text without the lines that another
    document holds first.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Keys of
    at least ``least`` code points that occur under two or more ids lose their lines
    everywhere but in the smallest id. A null or empty text is one empty line. Rows with
    equal ids are one document; null ids are one document that comes after all others.
    Repeats inside one document stay. An empty table gives an empty result. ``bits`` is
    log2 of the filter's size; a small one only shuffles more suspects.
    """
    prepare(df.sparkSession)
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    if bits is None:
        # a key and its line break take more than ``least`` bytes
        lines = docs.agg(F.sum(F.least(F.octet_length("text") / (least + 1), F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1))).first()[0]
        bits = filter_bits(int(lines or 0))
    name = ship_filter(twice_seen(docs, bits, least), bits)
    suspects = written(_suspects(docs, kind, name, bits, least), "suspects")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
    confirmed = suspects.groupBy("key").agg(F.min(order).alias("low"), F.max(order).alias("high"), F.count(F.lit(1)).alias("n"))
    confirmed = written(confirmed.where("low <> high").select("key", F.col("low.doc_id").alias("first"), F.col("n")), "repeated")
    hot = confirmed.where(F.col("n") > suspects.count() / HOT_SHARE).select("key", F.col("first").alias("hot"))
    # at most HOT_SHARE keys have that many rows; all others are small groups
    marked = suspects.join(F.broadcast(hot.withColumn("is_hot", F.lit(True))), "key", "left")
    often = marked.where("is_hot").select("doc_id", "key", F.col("hot").alias("first"))
    rest = marked.where("is_hot is null").select("doc_id", "key").join(confirmed.select("key", "first"), "key")
    gone = often.unionByName(rest.select("doc_id", "key", "first")).where("not (doc_id <=> first)")
    lists = gone.groupBy("doc_id").agg(F.collect_set("key").alias("gone"))
    lists = lists.withColumnRenamed("doc_id", "__id")
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(lists["__id"]), "left").select("doc_id", "text", "gone")
    return _strip(joined, kind, least)
