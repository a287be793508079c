"""Token ids as Parquet files that can be read selectively.

Texts are range-partitioned by id, encoded by the tokenizers library and written by Spark:
ids as a dictionary-encoded list column, metadata delta-encoded, small row groups and pages
with page indexes. A reader takes single columns (counts without ids) or id ranges.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from sifter.llm.common import array_blocks, held, prepare, shared_path
from sifter.llm.files import local, ship
from sifter.llm.pieces import PIECE_BYTES, PieceMemo

END_ID = 2
#: Pieces that a worker remembers (some 200 MB), and bytes of texts it works on at once.
MEMO_PIECES = 1 << 20
BLOCK_BYTES = 4 << 20
#: Pieces handed to the library in one string.
JOINED = 2000
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10

#: A token of a byte-level vocabulary never spans a step from other characters to white space.
_PIECE = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
#: Other white space, or what may be a special token: such a text is encoded in one go.
_ODD = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|<\|"
#: What keeps a text from being cut at every blank and line feed, see ``PieceEncoder.cut``.
_RUNS = r"[ \n]{2}|[\t\r\x{b}\x{c}\x{0}]"


class _Whole(str):
    """A text that is encoded in one go."""


class PieceEncoder(PieceMemo):
    """Ids of texts by the tokenizers library. New pieces that begin with white space are put
    in one string for it; the ids' byte lengths tell where each piece's ids end."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__(MEMO_PIECES)
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(1 + max(vocabulary.values()), np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)  # a byte-level token has one character a byte

    def cut(self, texts: pa.Array) -> list:
        odd, runs = (pc.match_substring_regex(texts, x).to_numpy(zero_copy_only=False) for x in (_ODD, _RUNS))
        plain, parts = np.flatnonzero(~odd & ~runs), []
        if len(plain):
            # single blanks and line feeds: the pieces begin with them, without a regular expression
            marked = pc.replace_substring(pc.replace_substring(texts.take(pa.array(plain)), " ", "\0 "), "\n", "\0\n")
            parts.append(self.distinct(plain, pc.split_pattern(marked, "\0")))
        for k in np.flatnonzero(odd | runs).tolist():
            text = texts[k].as_py()
            numbers: dict[str, int] = {}
            of = [numbers.setdefault(p, len(numbers)) for p in ([_Whole(text)] if odd[k] else _PIECE.findall(text))]
            parts.append((np.array([k]), np.array([len(of)]), list(numbers), np.array(of, np.int64)))
        return sorted(parts, key=lambda p: len(p[2]) == 1 and len(p[2][0]) > PIECE_BYTES)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joins = [p[:1] in " \t\n\r\x0b\x0c" and type(p) is str and p != "" and not p.isspace() for p in pieces]
        many = [p for p, j in zip(pieces, joins, strict=True) if j]
        found = self._encode([p for p, j in zip(pieces, joins, strict=True) if not j])
        lengths, joined = np.zeros(len(pieces), np.int64), np.array(joins, bool)
        lengths[~joined] = list(map(len, found))
        ids = np.array([i for f in self._encode(["".join(many[k: k + JOINED]) for k in range(0, len(many), JOINED)]) for i in f], np.uint32)
        ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum([len(p.encode()) for p in many]), side="right") if many else np.zeros(0, np.int64)
        lengths[joined] = np.diff(ends, prepend=0)
        out = np.zeros(int(lengths.sum()), np.uint32)
        apart = np.repeat(~joined, lengths)
        out[apart], out[~apart] = [i for f in found for i in f], ids
        return out, lengths


def _encoder(name: str) -> PieceEncoder:
    """One for all tasks of a worker process, so what it remembers lasts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held(("byte encoder", name), lambda: PieceEncoder(Tokenizer.from_file(local(name))))


def write_tokens(df: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end: int = END_ID) -> None:
    """Write (part int, doc_id, first long, n_tokens long, ids array<int>) in ascending id
    order, file after file; ``first`` counts the ids before the document in its part.

    Null texts count as empty (they get the end id alone); null ids come first; rows with
    equal ids are ordered by text hash. An empty table writes no rows.
    """
    spark = df.sparkSession
    prepare(spark)
    name = ship(spark, vocabulary)
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"), F.xxhash64(F.col(text)).alias("__order"))
    rows = rows.repartitionByRange("doc_id", "__order").sortWithinPartitions("doc_id", "__order").select("doc_id", "__text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(name), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, texts in array_blocks(batch.column(1), BLOCK_BYTES):
                ids, offsets = encoder.encode(texts)
                ids = np.insert(ids.view(np.int32), offsets[1:], end)
                offsets = offsets + np.arange(len(offsets))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(texts), part, np.int32)), batch.column(0).slice(first, len(texts)),
                    pa.array(before + offsets[:-1]), pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids))], ["part", "doc_id", "first", "n_tokens", "ids"])
                before += int(offsets[-1])

    options = {"parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES, "parquet.writer.version": "v2",
               "parquet.dictionary.page.size": 1 << 20, "parquet.enable.dictionary#ids.list.element": "true", "compression": "zstd"}
    options |= {f"parquet.enable.dictionary#{c}": "false" for c in ("part", "doc_id", "first", "n_tokens")}
    (rows.mapInArrow(run, f"part int, doc_id {kind}, first bigint, n_tokens bigint, ids array<int>")
     .write.options(**{k: str(v) for k, v in options.items()}).parquet(path))


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The files' rows, or those with low <= doc_id < high; the bounds reach the row group
    statistics and page indexes, and unused columns are not read."""
    rows = spark.read.parquet(path)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    return rows.where(F.col("doc_id") < high) if high is not None else rows


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(part, before): ids in the files before each part; reads the counts alone. One row a file."""
    sums = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 as read back from the files."""
    prepare(spark)
    rows = read_tokens(spark, path).select("part", "doc_id", "first", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
            crcs = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crcs, pa.int64())],
                                             ["part", "doc_id", "first", "n_tokens", "ids_crc32"])

    digests = rows.mapInArrow(run, f"part int, doc_id {kind}, first bigint, n_tokens bigint, ids_crc32 bigint")
    return digests.join(F.broadcast(read_index(spark, path)), "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def store(df: DataFrame, vocabulary: str, **columns: str) -> DataFrame:
    """Write ``df``'s tokens to a new shared folder and return the digests read back."""
    spark = df.sparkSession
    path = shared_path(spark, "tokens")
    write_tokens(df, path, vocabulary, **columns)
    return token_digests(spark, path)
