"""Consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of segments; each shard owns ``replicas`` tokens on it. A key
belongs to the first token clockwise from its segment. A shard takes keys up to its bound;
those beyond go on clockwise to the next shard with room. Which keys a shard keeps is
decided per segment from row counts alone (a table bounded by the segments), so the rows
themselves are only ranked inside small groups and never gathered.
"""

from __future__ import annotations

import bisect

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sifter.llm.common import written

SHARDS = 24
REPLICAS = 64
SEGMENT_BITS = 14
#: A segment with more rows than this, and than twice the mean, is ranked in parts.
GROUP_ROWS = 8192


def tokens(shards: int, replicas: int = REPLICAS, seed: int = 0) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node in ring order; a shard's tokens don't depend
    on the number of shards."""
    return sorted((xxhash.xxh64_intdigest(f"{s}:{r}", seed), s) for s in range(shards) for r in range(replicas))


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """The rows each shard may hold: with no slack they sum up to ``rows`` and differ by at
    most one; otherwise (1 + slack) times the mean, rounded up."""
    if slack > 0:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def allot(units: list[tuple[int, int, int]], ring: list[tuple[int, int]], room: list[int],
          bits: int = SEGMENT_BITS) -> list[tuple[int, int, int, int, int, int]]:
    """(segment, part, from rank, to rank, shard, first slot) for ``units`` of (segment,
    part, rows): first every shard takes from its own arcs in ring order, then what was
    too much walks on clockwise to the next shard with room."""
    places, room, used = [p for p, _ in ring], list(room), [0] * len(room)
    out, rest = [], []

    def take(unit, low, high, shard):
        n = min(high - low, room[shard])
        if n > 0:
            out.append((unit[0], unit[1], low, low + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return low + max(n, 0)

    for unit in sorted(units):
        home = bisect.bisect_left(places, unit[0] << (64 - bits)) % len(ring)
        at = take(unit, 0, unit[2], ring[home][1])
        if at < unit[2]:
            rest.append((unit, at, home))
    for unit, at, home in rest:
        step = home
        while at < unit[2]:
            step = (step + 1) % len(ring)
            at = take(unit, at, unit[2], ring[step][1])
            if step == home and at < unit[2]:
                raise ValueError("the shards have less room than rows")
    return out


def shard_rows(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, slack: float = 0.0,
               replicas: int = REPLICAS, bits: int = SEGMENT_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``doc_id`` (the key), size, text_crc32, shard and slot of every row.

    Size is the text's UTF-8 bytes plus 8; a null text counts as empty. Null keys share
    one ring position. Rows with equal keys are ordered by text checksum, size and file
    position; a segment swollen by them is ranked in several parts. An empty table gives
    an empty result.
    """
    spark = df.sparkSession
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    light = written(df.select(
        F.col(key).alias("doc_id"), (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(F.col(key)), 64 - bits).cast("int").alias("seg"),
        F.monotonically_increasing_id().alias("rid")), "ring")
    counts = {r[0]: r[1] for r in light.groupBy("seg").agg(F.count(F.lit(1))).collect()}  # at most 2**bits rows
    total = sum(counts.values())
    limit = max(group_rows, 2 * total >> bits)
    hot = {seg: -(-n // limit) for seg, n in counts.items() if n > limit}
    units = [(seg, 0, n) for seg, n in counts.items() if seg not in hot]
    light = light.withColumn("part", F.lit(0))
    if hot:
        parts = spark.createDataFrame(sorted(hot.items()), "seg int, parts int")  # sum of parts: below total / limit + segments
        salt = F.pmod(F.xxhash64("text_crc32", "size", "rid"), F.coalesce("parts", F.lit(1))).cast("int")
        light = light.drop("part").join(F.broadcast(parts), "seg", "left").withColumn("part", salt).drop("parts")
        units += [tuple(r) for r in light.where(F.col("seg").isin(list(hot)) if len(hot) < 100 else F.lit(True))
                  .groupBy("seg", "part").agg(F.count(F.lit(1))).collect() if r[0] in hot]
    plan = spark.createDataFrame(allot(units, tokens(shards, replicas), bounds(total, shards, slack), bits),
                                 "seg int, part int, low long, high long, shard int, first long")
    order = Window.partitionBy("seg", "part").orderBy("doc_id", "text_crc32", "size", "rid")
    ranked = light.withColumn("rank", F.row_number().over(order) - 1)
    ranked, plan = ranked.alias("r"), F.broadcast(plan).alias("p")  # at most one row per unit and shard bound
    return (ranked.join(plan, (F.col("r.seg") == F.col("p.seg")) & (F.col("r.part") == F.col("p.part"))
                        & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - F.col("low")).alias("slot")))
