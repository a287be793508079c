"""Exact removal of repeated byte strings with suffix arrays.

Every string of WIDTH bytes holds one minimiser, its smallest hashed k-gram; equal strings
hold the same one. So all starts that share a minimiser and lie next to each other form a
region, only regions whose minimiser occurs again can hold repeats, and equal strings meet
in the shard of their minimiser. Regions with equal bytes are merged first. Each shard
builds a suffix array (Larsson-Sadakane), its common prefixes (Kasai), and marks starts
whose neighbours share WIDTH bytes. The regions of a minimiser with very many occurrences
are dealt to several shards, whose sorted strings are then merged by binary search.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import hot_join, prepare, text_blocks, written
from sifter.llm.suffix_array import common_prefixes, packed, suffix_array

WIDTH = 200
GRAM = 64
#: Bytes of a suffix array at most, unless one minimiser's regions take more.
SHARD_BYTES = 1 << 20
#: Occurrences of a minimiser beyond which its regions are dealt to several shards.
SPLIT = 2048
#: Strings of split minimisers that a merging task holds.
MERGED = 1 << 17
#: Starts of a long text that are worked on at once.
STARTS = 1 << 20

_MIX = np.random.default_rng(7).integers(1, 1 << 63, 300, dtype=np.uint64) | np.uint64(1)


def minimisers(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the minimiser, its offset from the start) for each start of ``width`` bytes;
    the leftmost of equal hashes. ``gram`` is a power of two."""
    count = len(data) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = _MIX[data]
    step, level = 1, 256
    while step < gram:
        value = value[:-step] * _MIX[level] + value[step:]
        step, level = 2 * step, level + 1
    value ^= value >> np.uint64(31)
    value *= _MIX[level]
    value ^= value >> np.uint64(29)
    span = width - gram + 1  # k-grams in a string
    offset = np.zeros(len(value), np.uint8 if span < 256 else np.int32)
    step = 1

    def lower(shift: int, size: int) -> None:
        nonlocal value, offset
        left, right = value[:size], value[shift: shift + size]
        take = right < left
        value = np.where(take, right, left)
        offset = np.where(take, offset[shift: shift + size] + offset.dtype.type(shift), offset[:size])

    while 2 * step <= span:
        lower(step, len(value) - step)
        step *= 2
    if step < span:
        lower(span - step, len(value) - (span - step))
    return value[:count], offset[:count].astype(np.int64)


def regions(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, minimiser hash) of a text's regions."""
    out = []
    for low in range(0, max(0, len(data) - width + 1), STARTS):
        hashes, offset = minimisers(data[low: low + STARTS + width - 1], width, gram)
        place = np.arange(len(hashes)) + offset
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        out.append((first + low, np.diff(np.append(first, len(hashes))), hashes[first]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate([x[k] for x in out]) for k in range(3))


def repeated_starts(texts: list[bytes], width: int = WIDTH) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """From one suffix array over ``texts``: for each text the repeated starts as a flag per
    start; then (text, start, alone) of one start for each distinct string, in order."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends = (starts + sizes)[owner]
    keys = packed(data, ends)
    order, rank = suffix_array(keys, ends, owner)
    linked = common_prefixes(keys, order, rank, starts[sizes >= width], ends, width) >= width
    flag = linked.copy()
    flag[:-1] |= linked[1:]
    marks = np.zeros(len(data), bool)
    marks[order] = flag
    heads = np.flatnonzero(~linked & (ends[order] - order >= width))
    head = order[heads]
    own = [marks[s: s + max(0, n - width + 1)] for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
    return own, owner[head], head - starts[owner[head]], ~flag[heads]


def _ranges(flags: np.ndarray) -> list[int]:
    """[from, to, from, to, ...] of the runs of set flags."""
    return np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))).tolist()


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _same(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on (doc_id, h); null ids are equal to each other."""
    b = b.withColumnsRenamed({"doc_id": "__id", "h": "__h"})
    return a.join(b, a["doc_id"].eqNullSafe(b["__id"]) & (a["h"] == b["__h"]), how).drop("__id", "__h")


def _scan(docs: DataFrame, kind: str, width: int, gram: int) -> DataFrame:
    """(doc_id, h, start, n, m) of every region of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_blocks(batch.column(2), 1 << 20):
                found = [regions(np.frombuffer(t.encode(), np.uint8), width, gram) for t in texts]
                at = pa.array(np.repeat(np.arange(first, first + len(texts)), [len(f[0]) for f in found]))
                start, n, m = (np.concatenate([f[k] for f in found]) for k in range(3))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(start), pa.array(n.astype(np.int32)),
                                                  pa.array(m.view(np.int64))], ["doc_id", "h", "start", "n", "m"])

    return docs.mapInArrow(run, f"doc_id {kind}, h bigint, start bigint, n int, m bigint")


def _cut(docs: DataFrame, kind: str, width: int) -> DataFrame:
    """(doc_id, h, start, n, m, c, rid, data) of the regions listed in start, n, m and c; a task
    hands out the bytes of equal regions once while it remembers them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ends = batch.column(3).offsets.to_numpy()
            ends = ends - ends[0]
            columns = [batch.column(k).flatten() for k in range(3, 7)]
            starts, counts = (columns[k].to_numpy().tolist() for k in (0, 1))
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            rids, pieces, size, low = [], [], 0, 0

            def out() -> pa.RecordBatch:
                at = pa.array(row[low: low + len(rids)])
                return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *[c.slice(low, len(rids)) for c in columns],
                                                   pa.array(rids, pa.binary()), pa.array(pieces, pa.binary())], ["doc_id", "h", "start", "n", "m", "c", "rid", "data"])

            for k in range(batch.num_rows):
                data = batch.column(2)[k].as_py().encode()
                for i in range(ends[k], ends[k + 1]):
                    piece = data[starts[i]: starts[i] + counts[i] + width - 1]
                    rid = xxhash.xxh3_128_digest(piece)
                    rids.append(rid)
                    pieces.append(None if rid in seen else piece)
                    seen.add(rid)
                    size += len(piece)
                    if size > 1 << 22:
                        yield out()
                        low, rids, pieces, size = low + len(rids), [], [], 0
                if len(seen) > 1 << 18:
                    seen.clear()
            if rids:
                yield out()

    return docs.mapInArrow(run, f"doc_id {kind}, h bigint, start bigint, n int, m bigint, c bigint, rid binary, data binary")


def _sort_shards(distinct: DataFrame, width: int, shard_bytes: int) -> DataFrame:
    """Suffix arrays over the regions of each key ``sk``; keys with few bytes share one.

    (rid, ranges) of repeated starts; for split minimisers also (rid, m, sk, digest, at) of
    one start for each distinct string that did not repeat in its shard, and of one that did.
    """

    names = ["rid", "ranges", "m", "sk", "digest", "at", "alone"]
    kinds = (pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.bool_())

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        flags, text, at, alone = repeated_starts([r[2] for r in rows], width)
        marked = [(r[0], _ranges(f)) for r, f in zip(rows, flags, strict=True) if f.any()]
        columns = [pa.array([x[k] for x in marked], kinds[k]) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(marked), t) for t in kinds[2:]]], names)
        split = np.array([r[4] for r in rows], bool)[text]
        text, at, alone = text[split], at[split], alone[split]
        rid, m, sk = (pa.array([r[k] for r in rows], t) for k, t in ((0, pa.binary()), (3, pa.int64()), (1, pa.int64())))
        for low in range(0, len(text), 1 << 14):
            some = slice(low, low + (1 << 14))
            take = pa.array(text[some])
            digests = [xxhash.xxh3_128_digest(rows[t][2][a: a + width]) for t, a in zip(text[some].tolist(), at[some].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rid.take(take), pa.nulls(len(take), kinds[1]), m.take(take), sk.take(take), pa.array(digests, pa.binary()),
                                              pa.array(at[some].astype(np.int32)), pa.array(alone[some])], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and size >= shard_bytes and row[1] != group[-1][1]:
                    yield from solve(group)
                    group, size = [], 0
                group.append(row)
                size += len(row[2])
        if group:
            yield from solve(group)

    rows = distinct.select("rid", "sk", "data", "m", "split").repartition("sk").sortWithinPartitions("sk")
    return rows.mapInArrow(run, "rid binary, ranges array<int>, m bigint, sk bigint, digest binary, at int, alone boolean")


def _merge_shards(heads: DataFrame) -> DataFrame:
    """(rid, ranges) of lone starts whose string also occurs in another shard of the same
    minimiser. The strings are dealt by ranges and sorted; a task takes a bounded piece of
    its range at a time and looks each shard's run up in all runs by binary search."""

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        every = np.frombuffer(b"".join(table.column("digest").to_pylist()), "S16")
        shard = table.column("sk").to_numpy()
        order = np.argsort(shard, kind="stable")
        alone = table.column("alone").to_numpy()
        for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            strings = every[own]  # distinct and sorted inside a shard
            others = np.searchsorted(every, strings, "right") - np.searchsorted(every, strings, "left") > 1
            hit = own[others & alone[own]]
            if len(hit):
                at = table.column("at").take(pa.array(hit)).to_numpy()
                ranges = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(hit) + 1, 2, dtype=np.int32)), pa.array(np.column_stack((at, at + 1)).ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([table.column("rid").take(pa.array(hit)).combine_chunks(), ranges], ["rid", "ranges"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= MERGED:
                table = pa.Table.from_batches(held).combine_chunks()
                last = table.column("digest")[-1]
                cut = pc.index(table.column("digest"), last).as_py()  # the last string may go on
                if cut:
                    yield from found(table.slice(0, cut).combine_chunks())
                    held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield from found(pa.Table.from_batches(held).combine_chunks())

    rows = heads.select("rid", "sk", "digest", "at", "alone").repartitionByRange("digest").sortWithinPartitions("digest")
    return rows.mapInArrow(run, "rid binary, ranges array<int>")


def _strip(docs: DataFrame, kind: str, width: int) -> DataFrame:
    """(doc_id, spans, kept): maximal removed byte runs and the remaining bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            spans, sizes, kept = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                data = text.encode()
                runs = values[ends[k]: ends[k + 1]].reshape(-1, 2)
                if len(runs):
                    runs = runs[np.argsort(runs[:, 0])]
                    reach = np.maximum.accumulate(runs[:, 1]) + width - 1
                    first = np.flatnonzero(np.concatenate(([True], runs[1:, 0] > reach[:-1])))
                    runs = np.column_stack((runs[first, 0], np.append(reach[first[1:] - 1], reach[-1])))
                    edges = [0, *runs.ravel().tolist(), len(data)]
                    data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    spans.append(runs)
                sizes.append(len(runs))
                kept.append(data)
            flat = np.concatenate([np.zeros((0, 2), np.int64), *spans])
            pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "stop"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pairs),
                                              pa.array(kept, pa.binary())], ["doc_id", "spans", "kept"])

    return docs.mapInArrow(run, f"doc_id {kind}, spans array<struct<start:bigint,stop:bigint>>, kept binary")


def repeated_bytes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, split: int = SPLIT) -> DataFrame:
    """doc_id, ``spans`` (maximal runs of bytes covered by a string of ``width`` bytes that
    starts anywhere else too, byte offsets) and ``kept``, the remaining bytes.

    All repeats go, no first copy stays. A null text counts as empty; texts shorter than
    ``width`` keep everything; repeated rows are separate texts; null ids are allowed. An
    empty table gives an empty result.
    """
    prepare(df.sparkSession)
    docs = _keyed(df, doc_id, text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = written(_scan(docs, kind, width, gram), "regions")
    common = scanned.groupBy("m").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    # rows with equal id and text have equal regions, so a set holds them once
    lists = hot_join(scanned, written(common, "minimisers"), "m", "c").groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "n", "m", "c")).alias("parts"))
    parts = written(lists, "candidates")
    found = _same(docs, parts, "inner").select("doc_id", "h", "text", *[F.col("parts")[c].alias(c) for c in ("start", "n", "m", "c")])
    cut = written(_cut(found, kind, width), "pieces")

    distinct = cut.groupBy("rid", "m", "n").agg(F.count(F.lit(1)).alias("copies"), F.first("data", ignorenulls=True).alias("data"), F.max("c").alias("c"))
    subs = F.ceil(F.col("c") / F.lit(split))
    distinct = distinct.withColumn("split", subs > 1).withColumn(
        "sk", F.when(subs > 1, F.xxhash64("m", F.pmod(F.xxhash64("rid"), subs))).otherwise(F.col("m")))
    distinct = written(distinct, "distinct")
    solved = written(_sort_shards(distinct, width, shard_bytes), "shards")
    whole = distinct.where("copies > 1").select("rid", F.array(F.lit(0), F.col("n")).alias("ranges"))
    inner = solved.where("ranges is not null").select("rid", "ranges")
    across = _merge_shards(solved.where("digest is not null"))
    # a region has at most width - gram + 1 starts, so its lists are short
    marked = whole.union(inner).union(across).groupBy("rid").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    marked = written(marked.join(distinct.select("rid", "copies"), "rid"), "marked")
    hits = hot_join(cut.select("doc_id", "h", "rid", "start"), marked, "rid", "copies")
    hits = hits.select("doc_id", "h", F.transform("ranges", lambda x: x + F.col("start")).alias("runs"))
    hits = hits.groupBy("doc_id", "h").agg(F.flatten(F.collect_set("runs")).alias("runs"))  # first and behind-last start of each run
    stripped = _same(docs, written(hits, "hits"), "left")
    return _strip(stripped.select("doc_id", "text", F.coalesce("runs", F.array().cast("array<bigint>")).alias("runs")), kind, width)
