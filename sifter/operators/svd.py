"""Latent semantic encoder (E1/E2): randomised SVD of the hashed term matrix.

The matrix has one row a document and ``terms`` columns: every token is hashed to a signed column
(as in the default encoder), so that all words take part and no vocabulary is kept. An entry is
``sign(c) ln(1 + |c|) idf``, rows have unit length. The fit goes through the matrix ``rounds`` + 2
times, without shuffling it:

* ``Y = A' (A Q)`` from a random start: each task adds up its own rows and hands on blocks of columns,
  which are added up in a tree (tasks, about their root, one). ``Y`` has ``terms`` x (``dim`` +
  ``oversample``) numbers whatever the corpus, 50 MB by default; the driver orthonormalises it;
* at the end the Gram matrix of ``A Q`` (one small square a task, the same tree) turns ``Q`` into right
  singular vectors.

A document's vector is its row times those vectors, of unit length. NULL texts have no row in the
fit and a NULL vector; texts without tokens have the zero vector; an empty table gives a
model whose vectors are all zero. Where the matrix has a rank below ``dim``, the other components are 0.
Sums are added in the order in which tasks end, so that last digits of a fit may differ.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.functions import text as T
from sifter.operators.common import materialize
from sifter.operators.embedding import signed_buckets
from sifter.session import ensure_workers

TERMS = 1 << 16
DIM = 64
OVERSAMPLE = 32
ROUNDS = 4
BLOCK = 1024  # columns in one block of partial sums
CELLS = 1 << 16  # entries multiplied at a time
PARTIAL = "block int, part int, data binary"


def _lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(values))


def term_matrix(df: DataFrame, id_col: str, text_col: str = "text", terms: int = TERMS) -> DataFrame:
    """``(id, cols ARRAY<INT>, counts ARRAY<INT>)``: signed counts of a text's columns, those that
    are not 0, in ascending order. Rows with a NULL text are left out. No shuffle."""
    ensure_workers(df.sparkSession)
    tokens = df.where(F.col(text_col).isNotNull()).select(id_col, signed_buckets(F.col(text_col), terms).alias("sb"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            cells, at = np.unique(row * terms + np.where(ids >= 0, ids, -ids - 1), return_inverse=True)
            n = np.bincount(at, weights=np.where(ids >= 0, 1, -1), minlength=len(cells))
            cells, n = cells[n != 0], n[n != 0].astype(np.int32)
            lengths = np.bincount(cells // terms, minlength=len(lists))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(lengths, (cells % terms).astype(np.int32)), _lists(lengths, n)],
                [id_col, "cols", "counts"])

    kind = df.schema[id_col].dataType.simpleString()
    return tokens.mapInArrow(count, f"`{id_col}` {kind}, cols array<int>, counts array<int>")


def _weighted(batch: pa.RecordBatch, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a batch of ``term_matrix``: (row, column, weight), rows ascending and of unit length."""
    lists = batch.column("cols")
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    col = lists.flatten().to_numpy(zero_copy_only=False)
    n = batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    w = np.sign(n) * np.log1p(np.abs(n)) * idf[col]
    norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(lists)))
    return row, col, w / norm[row]


def _add_up(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows added up by key; equal keys are neighbours and there is at least one."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(rows, starts, axis=0)


def _slices(row: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of entries of whole rows: at most ``CELLS`` of them, or one row."""
    at = 0
    while at < len(row):
        end = min(at + CELLS, len(row))
        if end < len(row):
            end = int(np.searchsorted(row, row[end]))
            if end <= at:
                end = int(np.searchsorted(row, row[at], side="right"))
        yield at, end
        at = end


def times(batch: pa.RecordBatch, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The batch's rows times ``basis``."""
    row, col, w = _weighted(batch, idf)
    out = np.zeros((batch.num_rows, basis.shape[1]))
    for a, b in _slices(row):
        keys, sums = _add_up(row[a:b], basis[col[a:b]] * w[a:b, None])
        out[keys] = sums
    return out


def _tree_sum(partials: DataFrame, tasks: int) -> dict[int, np.ndarray]:
    """Adds up the partial blocks of all tasks in two levels; one array a block reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                x = np.frombuffer(data.as_buffer(), dtype=np.float64)
                sums[block] = sums[block] + x if block in sums else x.copy()
        for block, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([x.tobytes()], pa.binary())], ["block", "part", "data"])

    fan = math.isqrt(max(tasks, 1))
    if fan > 1:
        partials = partials.repartition("block", F.pmod("part", F.lit(fan))).mapInArrow(add, PARTIAL)
    return {r.block: np.frombuffer(r.data, dtype=np.float64) for r in partials.repartition("block").mapInArrow(add, PARTIAL).collect()}


@dataclass(frozen=True)
class SvdModel:
    """``idf`` of the columns, ``basis`` (terms x dim: right singular vectors) and singular values.
    Called with a list of texts it is an encoder for the plans (``encoder=model``)."""

    idf: np.ndarray
    basis: np.ndarray
    values: np.ndarray

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Vectors of texts, tokens hashed in Python; the same columns as ``term_matrix``."""
        lengths, cols, counts = [], [], []
        for text in texts:
            n: dict[int, int] = {}
            for token in regex.findall(T.VECTOR_TOKEN_RE, text.lower()):
                h = hashlib.md5(token.encode()).hexdigest()
                col = int(h[:8], 16) % len(self.idf)
                n[col] = n.get(col, 0) + (1 if h[8] < "8" else -1)
            kept = sorted(c for c in n if n[c])
            lengths.append(len(kept))
            cols += kept
            counts += [n[c] for c in kept]
        batch = pa.RecordBatch.from_arrays([_lists(np.array(lengths, np.int64), np.array(cols, np.int32)),
                                            _lists(np.array(lengths, np.int64), np.array(counts, np.int32))], ["cols", "counts"])
        return _unit(times(batch, self.idf, self.basis))


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.where(norm > 0, x / np.where(norm > 0, norm, 1), 0).astype(np.float32)


def fit(df: DataFrame, id_col: str, text_col: str = "text", dim: int = DIM, terms: int = TERMS,
        oversample: int = OVERSAMPLE, rounds: int = ROUNDS, seed: int = 42) -> SvdModel:
    """The ``dim`` first right singular vectors of the term matrix of all texts. The sparse matrix is
    checkpointed once; each round is one job over it."""
    matrix = materialize(term_matrix(df, id_col, text_col, terms).select("cols", "counts"))
    spark, tasks, width = df.sparkSession, matrix.rdd.getNumPartitions(), dim + oversample
    n_docs = matrix.count()
    per_col = matrix.select(F.explode("cols").alias("col")).groupBy("col").agg(F.count(F.lit(1)).alias("n")).toPandas()
    held = np.zeros(terms)
    held[per_col["col"].to_numpy(np.int64)] = per_col["n"].to_numpy(np.float64)  # at most ``terms`` rows
    idf = np.log((1 + n_docs) / (1 + held)) + 1

    def run(step) -> dict[int, np.ndarray]:
        return _tree_sum(matrix.mapInArrow(step, PARTIAL), tasks)

    def back_and_forth(shared):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, q = shared.value
            sums = None
            for batch in batches:
                row, col, w = _weighted(batch, weights)
                for a, b in _slices(row):
                    if sums is None:
                        sums = np.zeros((len(weights), q.shape[1]))
                    part = w[a:b, None]
                    keys, z = _add_up(row[a:b], q[col[a:b]] * part)
                    order = np.argsort(col[a:b], kind="stable")
                    to_row = np.searchsorted(keys, row[a:b][order])
                    cols, y = _add_up(col[a:b][order], z[to_row] * part[order])
                    sums[cols] += y
            for block in range(0, 0 if sums is None else len(sums), BLOCK):
                data = sums[block:block + BLOCK]
                if data.any():
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                                      pa.array([data.tobytes()], pa.binary())], ["block", "part", "data"])
        return step

    def gram(shared):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, q = shared.value
            total = np.zeros((q.shape[1], q.shape[1]))
            for batch in batches:
                b = times(batch, weights, q)
                total += b.T @ b
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], ["block", "part", "data"])
        return step

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((terms, width)))[0]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((idf, q))
        y = np.zeros((terms, width))
        for block, data in run(back_and_forth(shared)).items():
            y[block:block + BLOCK] = data.reshape(-1, width)
        shared.unpersist()
        q = np.linalg.qr(y)[0]
    shared = spark.sparkContext.broadcast((idf, q))
    squares = run(gram(shared)).get(0, np.zeros(width * width)).reshape(width, width)
    shared.unpersist()
    values, turn = np.linalg.eigh((squares + squares.T) / 2)
    best = np.argsort(-values)[:dim]
    values = np.sqrt(np.maximum(values[best], 0))
    basis = (q @ turn[:, best]) * (values > 1e-7 * max(values.max(initial=0), 1e-300))
    largest = basis[np.argmax(np.abs(basis), axis=0), np.arange(basis.shape[1])]
    return SvdModel(idf, basis * np.where(largest < 0, -1, 1), values)


def encode(df: DataFrame, id_col: str, model: SvdModel, text_col: str = "text", out_col: str = "emb") -> DataFrame:
    """``(id, emb ARRAY<FLOAT>)`` of every row: NULL for a NULL text, zeros without tokens. The
    model is broadcast (its size does not depend on the corpus); no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _unit(times(batch, shared.value.idf, shared.value.basis))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(np.full(len(vectors), vectors.shape[1]), vectors.ravel())],
                                             [id_col, out_col])

    kind = df.schema[id_col].dataType.simpleString()
    known = term_matrix(df, id_col, text_col, len(model.idf)).mapInArrow(run, f"`{id_col}` {kind}, `{out_col}` array<float>")
    blank = df.where(F.col(text_col).isNull()).select(id_col, F.lit(None).cast("array<float>").alias(out_col))
    return known.unionByName(blank)
