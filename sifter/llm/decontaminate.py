"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by size. Of each item the smallest shingle hashes (bottom-k MinHash)
are its sketch; k follows from the largest size of its partition so that a document which
holds the wanted share of an item's shingles must hold one of the sketch. Documents are
streamed past the sketches, whatever their length, and every candidate is verified by the
exact number of distinct shingles that both have. Items go by in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import prepare, ragged, text_blocks

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Items (and characters of them) handed to the tasks at a time.
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16 << 20

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits of the lower-cased text."""
    return _WORD.findall(text.lower())


def sketch_size(shingles: int, containment: float = CONTAINMENT) -> int:
    """How many smallest hashes to keep for an item of that many shingles: one more than may
    be missing in the largest item of its size partition (up to the next power of two)."""
    largest = (1 << shingles.bit_length()) - 1
    return min(shingles, int(largest - np.ceil(containment * largest - 1e-9)) + 1)


class ItemIndex:
    """Sketches and shingles of a block of items, numbered exactly: a shingle is found by
    joining its words one by one through sorted tables of the items' word runs."""

    def __init__(self, items: list[tuple[int, str]], width: int = SHINGLE_WORDS, containment: float = CONTAINMENT):
        texts = [words(t or "") for _, t in items]
        self.width, self.containment = width, containment
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for ws in texts for w in ws))}
        runs = [[tuple(ws[k: k + width]) for k in range(len(ws) - width + 1)] for ws in texts]
        used = [k for k, r in enumerate(runs) if r]
        self.items = np.array([items[k][0] for k in used], np.int64)
        owner = np.array([n for n, k in enumerate(used) for _ in runs[k]], np.int64)
        grams = [g for k in used for g in runs[k]]
        code = np.array([[self.vocabulary[w] for w in g] for g in grams], np.int64).reshape(len(grams), width)
        self.tables, base = [], max(1, len(self.vocabulary))
        number = code[:, 0] if len(grams) else np.zeros(0, np.int64)
        for column in range(1, width):
            table, number = np.unique(number * base + code[:, column], return_inverse=True)
            self.tables.append(table)
        pairs = np.unique(np.stack((owner, number)), axis=1)  # distinct shingles of each item
        owner, number = pairs
        self.sizes = np.bincount(owner, minlength=len(used))
        hashes = np.zeros(int(number.max(initial=-1)) + 1, np.uint64)
        for g, n in {g: n for g, n in zip(grams, self.find_all(code))}.items():
            hashes[n] = xxhash.xxh64_intdigest(" ".join(g))
        order = np.lexsort((number, hashes[number], owner)) if len(number) else np.zeros(0, np.int64)
        place = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        sketch = np.array([sketch_size(int(n), containment) for n in self.sizes], np.int64)
        small = order[place < sketch[owner[order]]] if len(order) else order
        self.sketch, self.full = (self._postings(number[x], owner[x], len(hashes)) for x in (small, np.arange(len(number))))

    @staticmethod
    def _postings(number: np.ndarray, owner: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((owner, number))
        return np.concatenate(([0], np.cumsum(np.bincount(number, minlength=total)))), owner[order]

    @staticmethod
    def _look_up(postings: tuple[np.ndarray, np.ndarray], numbers: np.ndarray) -> np.ndarray:
        at, owner = postings
        return owner[ragged(at[numbers], at[numbers + 1] - at[numbers])]

    def find_all(self, code: np.ndarray) -> np.ndarray:
        """The shingle number of each row of word numbers; -1 when no item has it."""
        number, base = code[:, 0].copy() if len(code) else np.zeros(0, np.int64), max(1, len(self.vocabulary))
        alive = np.flatnonzero((code >= 0).all(axis=1)) if len(code) else number
        out = np.full(len(code), -1, np.int64)
        number = number[alive]
        for column, table in enumerate(self.tables, 1):
            key = number * base + code[alive, column]
            at = np.minimum(np.searchsorted(table, key), max(0, len(table) - 1))
            found = table[at] == key if len(table) else np.zeros(len(key), bool)
            alive, number = alive[found], at[found]
        out[alive] = number
        return out

    def matches(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item id, shared shingles, item's shingles) of all items contained enough."""
        get, codes, ends = self.vocabulary.get, [], [0]
        for t in texts:
            codes += [get(w, -1) for w in words(t)]
            codes.append(-1)  # no shingle spans two texts
            ends.append(len(codes))
        code = np.array(codes, np.int64)
        if len(code) < self.width or not len(self.items):
            return
        number = self.find_all(np.lib.stride_tricks.sliding_window_view(code, self.width))
        at = np.flatnonzero(number >= 0)
        text = np.searchsorted(np.array(ends), at, side="right") - 1
        for k in np.unique(text).tolist():
            own = np.unique(number[at[text == k]]) if len(texts) > 1 else np.unique(number[at])
            candidates = np.unique(self._look_up(self.sketch, own))
            if len(candidates):
                shared = np.bincount(self._look_up(self.full, own), minlength=len(self.items))[candidates]
                enough = shared >= self.containment * self.sizes[candidates] - 1e-9
                for item, n in zip(candidates[enough].tolist(), shared[enough].tolist(), strict=True):
                    yield k, int(self.items[item]), n, int(self.sizes[item])


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded rows and characters, streamed through the driver."""
    block, size = [], 0
    for row in items.select(F.col(item_id).cast("long"), text).where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or size + len(row[1]) > BLOCK_CHARS):
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


def contained_items(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", **options) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles and containment of each item that a document
    holds to 80 % or more of its distinct five-word shingles.

    Items of fewer than five words have no shingle and match nothing; null texts neither.
    Repeated documents are reported once each. An empty table on either side gives an
    empty result.
    """
    spark = df.sparkSession
    prepare(spark)
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id bigint, n_shared bigint, n_shingles bigint"
    found = spark.createDataFrame([], schema)
    for block in item_blocks(items, item_id, item_text):
        index = spark.sparkContext.broadcast(ItemIndex(block, **options))

        def run(batches: Iterable[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, texts in text_blocks(batch.column(1)):
                    if rows := list(index.value.matches(texts)):
                        at, item, shared, size = zip(*rows, strict=True)
                        ids = batch.column(0).take(pa.array([first + k for k in at]))
                        yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in (item, shared, size))], ["doc_id", "item_id", "n_shared", "n_shingles"])

        found = found.union(source.mapInArrow(run, schema))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def without_items(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` whose text contains no item, with all their columns and no shuffle."""
    spark = df.sparkSession
    prepare(spark)
    at = df.columns.index(text)
    for block in item_blocks(items, item_id, item_text):
        index = spark.sparkContext.broadcast(ItemIndex(block, **options))

        def run(batches: Iterable[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for first, texts in text_blocks(batch.column(at)):
                    clean[[first + row[0] for row in index.value.matches(texts)]] = False
                yield batch.filter(pa.array(clean))

        df = df.mapInArrow(run, df.schema)
    return df
