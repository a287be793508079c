"""Embeddings (E1-E3, E8): a pluggable encoder slot and the default hashing encoder.

The default encoder needs no model weights: every token (``[\\p{L}\\p{N}]+`` of the
lower-cased text) adds +-1 to one of ``dim`` buckets picked by its md5, and the
sum is L2-normalised (a normalised sum equals a normalised mean, so this is mean
pooling of one-hot token vectors). A worker cuts Latin texts and hashes a token
when it first meets it, and one ``bincount`` per row makes the dense vector. A neural
encoder can be plugged in as any function ``list[str] -> np.ndarray (n, dim)``; it is
called on ``encoder_batch_size`` texts at a time. Loading weights once per worker is up to the function (e.g. ``functools.cache``).
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TT

from sifter.functions import text as T
from sifter.params import Params
from sifter.session import ensure_workers

VECTOR = TT.ArrayType(TT.FloatType())


WORDS_KNOWN = 1 << 16  # words whose buckets a worker remembers


#: A character past U+024F: Java's and Python's lists of letters may be of different Unicode versions.
BEYOND_LATIN = r"[^\x{0}-\x{24F}]"
_ASCII_WORDS = bytes(b if chr(b).isalnum() else 32 for b in range(128)) + bytes(128)
_WORD = re.compile(r"[^\W_]+")


def _words(text: str) -> list[str]:
    """Tokens of a Latin text."""
    low = text.lower()
    return low.encode().translate(_ASCII_WORDS).decode().split() if low.isascii() else _WORD.findall(low)


class _Buckets(dict):
    """Signed bucket by token, each token hashed when first met; emptied when full."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, token: str) -> int:
        if len(self) >= WORDS_KNOWN:
            self.clear()
        digest = hashlib.md5(token.encode()).digest()
        b = int.from_bytes(digest[:4], "big") % self.dim
        self[token] = signed = b if digest[4] < 128 else -b - 1
        return signed


@functools.cache
def _known(dim: int) -> _Buckets:
    return _Buckets(dim)


def _lists(like: pa.Array, values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The values cut into lists, NULL where ``like`` is."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(values), mask=like.is_null())


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values and lengths of the lists; a NULL list has none."""
    return lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def _buckets_udf(dim: int):
    @F.arrow_udf("array<int>")
    def buckets(texts: pa.Array, tokens: pa.Array) -> pa.Array:
        known, flat, lengths = _known(dim), [], np.zeros(len(texts), np.int64)
        cut = tokens.to_pylist() if tokens.null_count < len(tokens) else [None] * len(tokens)
        for i, text in enumerate(texts.to_pylist()):
            words = _words(text) if text is not None else cut[i] or ()
            flat.extend(map(known.__getitem__, words))
            lengths[i] = len(words)
        none = pc.and_(texts.is_null(), tokens.is_null())
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(np.array(flat, np.int32)), mask=none)

    return buckets


def signed_buckets(text: Column, dim: int) -> Column:
    """Per token: ``bucket`` if its sign is +1, else ``-bucket - 1`` (ARRAY<INT>). Texts of Latin letters only,
    on which Java and Python agree, are cut by the worker, all others natively."""
    ensure_workers()
    latin = ~text.rlike(BEYOND_LATIN)
    tokens = F.regexp_extract_all(F.lower(text), F.lit(T.VECTOR_TOKEN_RE), 0)
    return _buckets_udf(dim)(F.when(latin, text), F.when(~latin, tokens))


def signed_cells(ids: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells ``row * dim + bucket`` of lists of signed buckets, and the signs."""
    values, lengths = _flat(ids)
    values = values.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(ids)), lengths) * dim + np.where(values >= 0, values, -values - 1), np.where(values >= 0, 1.0, -1.0)


def _densify_udf(dim: int):
    @F.arrow_udf(VECTOR)
    def densify(ids: pa.Array) -> pa.Array:
        """Signed bucket ids -> unit float32 vectors (zeros when there are no tokens)."""
        cells, signs = signed_cells(ids, dim)
        v = np.bincount(cells, signs, len(ids) * dim).astype(np.float64).reshape(len(ids), dim)  # integers if there is no cell
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        v = np.divide(v, norm, out=v, where=norm > 0).astype(np.float32)
        none = ids.is_null().to_numpy(zero_copy_only=False)
        return _lists(ids, v[~none].reshape(-1), np.where(none, 0, dim))
    return densify


def _encoder_udf(encoder: Callable[[list[str]], np.ndarray], batch_size: int):
    @F.pandas_udf(VECTOR)
    def encode(texts: pd.Series) -> pd.Series:
        out = [None] * len(texts)
        at = [i for i, t in enumerate(texts) if t is not None]
        for k in range(0, len(at), batch_size):
            part = at[k:k + batch_size]
            embs = np.asarray(encoder([texts.iloc[i] for i in part]), dtype=np.float32)
            norms = np.linalg.norm(embs, axis=1, keepdims=True)
            for i, e in zip(part, np.where(norms > 0, embs / np.where(norms > 0, norms, 1), embs)):
                out[i] = e
        return pd.Series(out)
    return encode


def embed_column(text: Column, params: Params,
                 encoder: Callable[[list[str]], np.ndarray] | None = None) -> Column:
    """Unit embedding of a text column (ARRAY<FLOAT>); NULL for a NULL text."""
    ensure_workers()
    if encoder is None:
        return _densify_udf(params.embedding_dim)(signed_buckets(text, params.embedding_dim))
    return _encoder_udf(encoder, params.encoder_batch_size)(text)


def embed(df: DataFrame, params: Params, text_col: str = "text", out_col: str = "emb",
          encoder: Callable[[list[str]], np.ndarray] | None = None) -> DataFrame:
    """Adds ``out_col``. Empty input gives an empty frame of the same schema."""
    return df.withColumn(out_col, embed_column(F.col(text_col), params, encoder))


def hashed_counts(df: DataFrame, id_col: str, params: Params, text_col: str = "text") -> DataFrame:
    """Sparse form of the default encoder: ``(id, bucket, cnt, weight)`` with the signed
    count per bucket and its unit-normalised float32 weight (non-zero buckets only)."""
    dim, kind = params.embedding_dim, df.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, signs = signed_cells(batch.column(1), dim)
            n = np.bincount(cells, signs, batch.num_rows * dim).astype(np.int64)
            cells = np.unique(cells)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cells // dim)), pa.array((cells % dim).astype(np.int32)), pa.array(n[cells])],
                                             [id_col, "bucket", "cnt"])

    rows = df.select(id_col, signed_buckets(F.col(text_col), dim).alias("sb")).mapInArrow(count, f"`{id_col}` {kind}, bucket int, cnt bigint")
    counts = rows.repartition(id_col).groupBy(id_col, "bucket").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") != 0)
    # a window, as the counts lie clustered by document: a second aggregate joined back would hash all tokens twice
    counts = counts.withColumn("_sq", F.sum(F.col("cnt") * F.col("cnt")).over(Window.partitionBy(id_col)))
    return counts.where(F.col(id_col).isNotNull()).select(
        id_col, "bucket", "cnt",
        (F.col("cnt").cast("double") / F.sqrt(F.col("_sq").cast("double"))).cast("float").alias("weight"))


def mean_pool(df: DataFrame, group_col: str, vec_col: str = "embedding") -> DataFrame:
    """E3 (re-aimed): L2-normalised centroid of the vectors of each group, long form
    ``(group, dim, value)``. Aggregates are partial per (group, dim), so a hot group is
    pre-aggregated on every partition before the shuffle."""
    cells = df.select(group_col, F.posexplode(vec_col).alias("dim", "x"))
    means = cells.groupBy(group_col, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    norms = means.groupBy(group_col).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("norm"))
    return means.join(norms, group_col).select(
        group_col, "dim",
        F.when(F.col("norm") > 0, F.col("m") / F.col("norm")).otherwise(F.col("m")).alias("value"))
