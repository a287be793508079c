"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed words and their character n-grams,
plus the mean of those of its pairs of neighbouring words (pairs of equal words are one
feature). A softmax over the sum gives the class. The vectors are trained by
stochastic gradient descent in numpy, in one task, on a sample of labelled rows of bounded
expected size; scoring runs over all rows with the trained table broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import prepare, ragged, text_blocks

BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4, 5)
#: Expected number of labelled rows to train on; fewer labels are all taken.
SAMPLE_ROWS = 3000
EPOCHS = 6
RATE = 0.5
SEED = 11
MEMO_WORDS = 1 << 17

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * _FACTOR
    return (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, feature buckets of all words, number of features of each): the
    word itself and its character n-grams with < and > at its ends."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        terms = (data + np.uint64(1)) * _FACTOR ** (place % 97 + 1).astype(np.uint64)
        whole = np.add.reduceat(terms, starts) if len(words) else np.zeros(0, np.uint64)
        parts, owners = [_bucket(whole)], [np.arange(len(words))]
        room = np.repeat(starts + sizes, sizes) - np.arange(len(data))
        for n in GRAMS:
            at = np.flatnonzero(room >= n)
            value = np.full(len(at), n, np.uint64)
            for k in range(n):
                value = value * np.uint64(0x100000001B3) + data[at + k] + np.uint64(1)
            parts.append(_bucket(value))
            owners.append(np.searchsorted(starts, at, side="right") - 1)
    owner, feature = np.concatenate(owners), np.concatenate(parts)
    order = np.argsort(owner, kind="stable")
    return whole, feature[order], np.bincount(owner, minlength=len(words))


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words; all pairs of equal words share bucket 0."""
    with np.errstate(over="ignore"):
        both = _bucket(hashes[:-1] * np.uint64(31) + hashes[1:] * _FACTOR)
    return np.where(hashes[:-1] == hashes[1:], 0, both)


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, share) of a text's features; nothing for a text without words."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    unique = {w: k for k, w in enumerate(dict.fromkeys(words))}
    code = np.fromiter(map(unique.__getitem__, words), np.int64, len(words))
    hashes, feature, sizes = word_features(list(unique))
    starts = np.cumsum(sizes) - sizes
    every, pairs = feature[ragged(starts[code], sizes[code])], pair_features(hashes[code])
    share = np.concatenate((np.full(len(every), 1 / len(every)), np.full(len(pairs), 1 / max(1, len(pairs)))))
    bucket, at = np.unique(np.concatenate((every, pairs)), return_inverse=True)
    return bucket, np.bincount(at, share).astype(np.float32)


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, class weights with the bias as last row) by stochastic gradient descent; steps
    of a row shrink with what it has moved so far. Order and start follow from ``seed``."""
    rng = np.random.default_rng(seed)
    vectors = (rng.random((BUCKETS, DIM), np.float32) - 0.5) / DIM
    weights = np.zeros((DIM + 1, 2), np.float32)
    moved, moved_weights = np.zeros(BUCKETS, np.float32), np.float32(0)
    rows = [document_features(t) for t in texts]
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            bucket, share = rows[k]
            mean = np.append(share @ vectors[bucket], np.float32(1)).astype(np.float32)
            logit = mean @ weights
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back, grad = weights[:-1] @ p, np.outer(mean, p)
            moved_weights += (grad**2).sum()
            weights -= rate * grad / np.sqrt(moved_weights + 1e-8)
            if len(bucket):
                moved[bucket] += share**2 * (back @ back)
                vectors[bucket] -= (rate * share / np.sqrt(moved[bucket] + 1e-8))[:, None] * back
    return vectors, weights


class Scorer:
    """Probabilities of class 1, with a bounded memory of the words' vector sums."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray):
        self.vectors, self.weights = vectors, weights
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sums, self.sizes, self.hashes = np.zeros((0, DIM), np.float32), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > MEMO_WORDS:
            self.forget()
        cut = [t.encode().split() for t in texts]
        words = [w for ws in cut for w in ws]
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            hashes, feature, sizes = word_features(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.sums = np.concatenate((self.sums, np.add.reduceat(self.vectors[feature], np.cumsum(sizes) - sizes, axis=0)))
            self.sizes, self.hashes = np.concatenate((self.sizes, sizes)), np.concatenate((self.hashes, hashes))
        code = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        ends = np.cumsum([0, *map(len, cut)])
        mean = np.zeros((len(texts), DIM + 1), np.float32)
        mean[:, -1] = 1
        for k, (s, e) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            if e > s:
                own = code[s:e]
                mean[k, :-1] = self.sums[own].sum(axis=0, dtype=np.float64) / self.sizes[own].sum()
                if len(own) > 1:
                    mean[k, :-1] += self.vectors[pair_features(self.hashes[own])].mean(axis=0, dtype=np.float64)
        logit = (mean @ self.weights).astype(np.float64)
        return 1 / (1 + np.exp(np.clip(logit[:, 0] - logit[:, 1], -700, 700)))


def sampled(doc_id: str, sample: int, total: int) -> Column:
    """Whether the hash of an id is among the lowest ``sample`` of ``total`` (60 bits are compared)."""
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << 60)) < F.lit((sample << 60) // total)


def training_rows(df: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, y) of about ``sample`` labelled rows, chosen by a hash of the id. A row
    labelled more than once counts once, by the majority; null labels, ids and texts don't count."""
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id"))
             .agg((F.avg(label) >= 0.5).cast("int").alias("y")))
    total = known.count()
    if total > sample:
        known = known.where(sampled("doc_id", sample, total))
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col(text).isNotNull())
    return source.join(F.broadcast(known), "doc_id")  # bounded by the sample


def fit(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Train in one task on the bounded sample (text, y), ordered by id. Without rows of both
    classes the model scores every text with the share of class 1 it saw, or 0.5."""
    prepare(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if found:
            found.sort()
            vectors, weights = train([r[1] for r in found], [r[2] for r in found])
            yield pa.RecordBatch.from_arrays([pa.array([vectors.tobytes()]), pa.array([weights.tobytes()])], ["vectors", "weights"])

    model = rows.select("doc_id", "text", "y").repartition(1).mapInArrow(run, "vectors binary, weights binary").collect()
    if not model:
        return np.zeros((BUCKETS, DIM), np.float32), np.zeros((DIM + 1, 2), np.float32)
    return (np.frombuffer(bytes(model[0][0]), np.float32).reshape(BUCKETS, DIM), np.frombuffer(bytes(model[0][1]), np.float32).reshape(DIM + 1, 2))


def scores(df: DataFrame, model: tuple[np.ndarray, np.ndarray], keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``score``, the probability of class 1, of each whole text. A text without
    words (or null) has only the bias to go by. Repeated rows come out repeated."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(*keys, F.col(text).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]] + ["score double"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            found = [scorer.score(texts) for _, texts in text_blocks(batch.column(batch.num_columns - 1))]
            if found:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(found))], [*keys, "score"])

    return source.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Every third id, by checksum: never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def classify(df: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) of every row of ``df``; learns from
    labelled rows that are not held out. A null id counts as not held out."""
    model = fit(training_rows(df, labels.where(~held_out(doc_id)), label, doc_id, text))
    rows = scores(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model, ["doc_id"])
    return rows.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
