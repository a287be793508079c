"""Exact top-k by integer inner product as a Voronoi kNN join.

Distinct vectors are grouped by their nearest pivot and, inside a cell, by rings of the
distance to it. From the cells' summaries (counts, radii, norms) follow a lower bound of
the k-th best score for each query cell and an upper bound of any score with each ring; a
ring is sent to a query cell only if its upper bound reaches that lower bound. Tiles of both
sides are then multiplied locally and the best of all tiles merged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sifter.llm.common import prepare, written

K = 5
SCALE = 256
#: At most so many pivots (the root of the number of vectors otherwise) and rings a cell.
PIVOTS = 256
RINGS = 16
TILE = 1024
QUERY_TILE = 256


def integer_vectors(df: DataFrame, vec_id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """Distinct (vec_id, v): floor(scale * x) of each component; null ids, null vectors and
    those with null or non-finite components are left out. Shorter vectors get zeros."""
    x = F.col(embedding)
    fine = F.forall(x, lambda c: F.coalesce((c.cast("double") > float("-inf")) & (c.cast("double") < float("inf")), F.lit(False)))
    rows = df.where(F.col(vec_id).isNotNull() & x.isNotNull() & fine).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
    rows = written(rows, "vectors")
    low, high = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if low != high:
        rows = rows.select("vec_id", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(high) - F.size("v"))).alias("v"))
    return rows.distinct()


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(rows, -1)


def _assign(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds ``cell``, ``dist`` to its pivot and the squared ``norm`` of the column ``v``."""
    names = [f.name for f in df.schema]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", cell int, dist double, norm double"
    at, squares = names.index("v"), (pivots**2).sum(axis=1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(at), batch.num_rows).astype(np.float64)
            norm = (x**2).sum(axis=1)
            d = np.sqrt(np.maximum(norm[:, None] + squares - 2 * x @ pivots.T, 0))
            cell = d.argmin(axis=1)
            exact = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(exact), pa.array(norm)], [*names, "cell", "dist", "norm"])

    return df.mapInArrow(run, schema)


def needed_rings(pivots: np.ndarray, queries: list, rings: list, k: int) -> list[tuple[int, int, int]]:
    """(query cell, cell, ring) of all rings that may hold one of the k best of a query.

    ``queries``: (cell, radius, least norm, greatest norm); ``rings``: (cell, ring, count,
    nearest, farthest, least norm, greatest norm); norms are squared.
    """
    if not queries or not rings:
        return []
    cell, ring, count, near, far, low, high = (np.array(x, np.float64) for x in zip(*rings, strict=True))
    cell = cell.astype(int)
    out = []
    for q, radius, least, most in queries:
        apart = np.sqrt(((pivots[cell] - pivots[q]) ** 2).sum(axis=1))
        closest = np.maximum(0, np.maximum(apart - far, near - apart) - radius)
        best = (most + high - closest**2) / 2
        # q.x = q.p + q.(x - p) with q within the radius of its own pivot
        dots = pivots[cell] @ pivots[q]
        reach = np.sqrt((pivots[cell] ** 2).sum(axis=1)) * radius
        best = np.minimum(best, dots + reach + np.sqrt(most) * far)
        worst = np.maximum((least + low - (apart + far + radius) ** 2) / 2, dots - reach - np.sqrt(most) * far)
        order = np.argsort(-worst)
        enough = np.searchsorted(np.cumsum(count[order]), k)
        bar = worst[order[enough]] if enough < len(order) else -np.inf
        keep = best >= bar - 1e-6 * (1 + abs(bar))
        out += [(int(q), int(c), int(r)) for c, r in zip(cell[keep], ring[keep], strict=True)]
    return out


def best_of_tile(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best of each query, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    size = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    exact = float(size) ** 2 * max(1, x.shape[1]) < 2**53  # sums that doubles hold exactly
    scores = (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else q @ x.T
    if len(ids) > k:
        bar = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
        rows, cols = np.nonzero(scores >= bar[:, None])
    else:
        rows, cols = np.nonzero(np.ones_like(scores, bool))
    value = scores[rows, cols]
    order = np.lexsort((cols, -value, rows))
    rows, cols, value = rows[order], cols[order], value[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    return rows[keep], ids[cols[keep]], value[keep]


def _tiles(df: DataFrame, group: list[str], parts: DataFrame, name: str, ident: str) -> DataFrame:
    """Rows of ``df`` collected into tiles: (group..., part, <name>_ids, <name>_v)."""
    return (df.join(F.broadcast(parts), group).withColumn("part", F.pmod(F.xxhash64(ident), F.col("parts")).cast("int"))
            .groupBy(*group, "part").agg(F.collect_list(F.struct(F.col(ident).alias("i"), "v")).alias("s"))
            .select(*group, F.col("part").alias(f"{name}_part"), F.col("s.i").alias(f"{name}_ids"), F.flatten("s.v").alias(f"{name}_v")))


def knn_join(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 50, k: int = K, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of highest integer inner product for
    each row whose id is divisible by ``every``; all, if there are fewer.

    A vec_id stands for one row: rows that repeat it with the same vector count once and are
    never each other's neighbours. Of equal vectors only the k + 1 smallest ids can be
    among the best, so no more take part, whatever the size of such a group. Scores
    are 64-bit. An empty table gives an empty result.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = written(integer_vectors(df, vec_id, embedding), "integers")
    order = Window.partitionBy("v").orderBy("vec_id")
    items = written(rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n"), "items")
    asked = rows.where(F.col("vec_id") % every == 0)
    keys = written(asked.groupBy("v").agg(F.min("vec_id").alias("qkey")), "query-vectors")
    count = keys.count() and items.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not count:
        return empty
    chosen = items.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(min(pivots, max(1, int(count**0.5)))).collect()
    points = np.array([r[0] for r in chosen], np.float64).reshape(len(chosen), -1)
    data, ask = written(_assign(items, points), "cells"), written(_assign(keys, points), "query-cells")

    # summaries: at most PIVOTS rows, then PIVOTS * RINGS
    spans = data.groupBy("cell").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"))
    ring = F.least(F.lit(RINGS - 1), F.floor((F.col("dist") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-12)) * RINGS)).cast("int")
    data = data.join(F.broadcast(spans), "cell").withColumn("ring", ring).drop("lo", "hi")
    ring_rows = data.groupBy("cell", "ring").agg(F.count(F.lit(1)), F.min("dist"), F.max("dist"), F.min("norm"), F.max("norm")).collect()
    query_rows = ask.groupBy("cell").agg(F.max("dist"), F.min("norm"), F.max("norm"), F.count(F.lit(1))).collect()
    pairs = needed_rings(points, [tuple(r)[:4] for r in query_rows], [tuple(r) for r in ring_rows], k + 1)
    data_parts = spark.createDataFrame([(r[0], r[1], -(-r[2] // TILE)) for r in ring_rows], "cell int, ring int, parts int")
    query_parts = spark.createDataFrame([(r[0], -(-r[4] // QUERY_TILE)) for r in query_rows], "cell int, parts int")
    plan = spark.createDataFrame(pairs, "qcell int, cell int, ring int")
    tiles = _tiles(data, ["cell", "ring"], data_parts, "x", "vec_id")
    blocks = _tiles(ask, ["cell"], query_parts, "q", "qkey").withColumnRenamed("cell", "qcell")
    # every needed (query cell, ring) pair meets tile by tile
    wide = plan.join(F.broadcast(data_parts), ["cell", "ring"]).select("qcell", "cell", "ring", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("x_part"))
    both = blocks.join(wide, "qcell").join(tiles, ["cell", "ring", "x_part"]).select("q_ids", "q_v", "x_ids", "x_v")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, q_v, x_ids, x_v = (c[row].values.to_numpy() for c in batch.columns)
                at, ids, score = best_of_tile(q_v.reshape(len(q_ids), -1), x_v.reshape(len(x_ids), -1), x_ids, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(ids), pa.array(score)], ["qkey", "vec_id", "score"])

    best = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    found = both.mapInArrow(run, "qkey bigint, vec_id bigint, score bigint").withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    owner = asked.join(keys, "v").select(F.col("vec_id").alias("query_id"), "qkey")
    own = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    return (owner.join(found, "qkey").where("vec_id <> query_id").withColumn("rank", F.row_number().over(own).cast("int"))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
