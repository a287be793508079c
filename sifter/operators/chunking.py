"""Sentences (T8/T9) and greedy sentence-aligned chunking with overlap.

Everything is per document row (no shuffle): the sentence array is a native
expression; the sequential fold that picks chunk boundaries runs in Python over
Arrow batches of each row's sentence array (word counts are ``len(s.split())``,
computed there in C), and returns only int ranges. The chunk text is then sliced
natively from the sentence array.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as TT

from sifter.functions import text as T
from sifter.params import Params
from sifter.session import ensure_workers

BOUNDS_TYPE = TT.ArrayType(TT.StructType([
    TT.StructField("s", TT.IntegerType(), False),
    TT.StructField("e", TT.IntegerType(), False),
    TT.StructField("n", TT.IntegerType(), False),
]))


def chunk_bounds(counts: list[int] | np.ndarray, max_words: int, overlap_words: int) -> list[tuple[int, int]]:
    """0-based inclusive sentence ranges of the chunks of one document.

    Greedy: a sentence that would push the open chunk past ``max_words`` closes it
    (unless the chunk is empty, so an over-long sentence stays whole); the next
    chunk starts with the longest run of trailing sentences of the closed one whose
    words sum to at most ``overlap_words``.
    """
    n = len(counts)
    if n == 0:
        return []
    out = []
    prefix = [0, *np.cumsum(np.asarray(counts, dtype=np.int64)).tolist()]
    st = 0
    for i in range(n):
        if prefix[i + 1] - prefix[st] > max_words and st < i:
            out.append((st, i - 1))
            p = st
            while prefix[i] - prefix[p] > overlap_words:
                p += 1
            st = p
    out.append((st, n - 1))
    return out


def _bounds_udf(max_words: int, overlap_words: int):
    @F.arrow_udf(BOUNDS_TYPE)
    def bounds(sents: pa.Array) -> pa.Array:
        words = np.array([len(s.split()) for s in sents.flatten().to_pylist()], np.int64)
        ends = np.cumsum(sents.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        total, first, ranges, n = np.concatenate(([0], np.cumsum(words))), 0, [], []
        for end in ends.tolist():
            found = chunk_bounds(words[first:end], max_words, overlap_words)
            ranges += [(a, b, total[first + b + 1] - total[first + a]) for a, b in found]
            n.append(len(found))
            first = end
        columns = np.array(ranges, np.int32).reshape(-1, 3)
        rows = pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], fields=[pa.field(x, pa.int32(), False) for x in "sen"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), rows)

    return bounds


def sentence_rows(docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``(id, sent_no, sent, n_words)`` one row per sentence, ``sent_no`` from 0."""
    return (docs.select(id_col, F.posexplode_outer(T.sentences(F.col(text_col))).alias("sent_no", "sent"))
            .where(F.col("sent_no").isNotNull())
            .withColumn("n_words", T.word_count(F.col("sent"))))


def chunk_documents(docs: DataFrame, id_col: str, params: Params, text_col: str = "text") -> DataFrame:
    """``(id, chunk_no, first_sent, last_sent, n_words, chunk)``.

    The Python step receives each row's sentence array and returns the chunk ranges
    with their word counts (``len(s.split())`` per sentence); the chunk text is sliced
    from the sentence array in the JVM.

    A document without sentences is one chunk holding its text (C3); a NULL text has no
    chunk. An explicit
    ``chunk_overlap_words=0`` means no overlap.
    """
    ensure_workers(docs.sparkSession)
    bounds = _bounds_udf(params.chunk_max_words, params.chunk_overlap_words)
    none = F.lit(None).cast("int")
    d = docs.where(F.col(text_col).isNotNull()).select(id_col, text_col).withColumn("sents", T.sentences(F.col(text_col)))
    d = d.withColumn("b", F.when(F.size("sents") > 0, bounds(F.col("sents")))
                     .otherwise(F.array(F.struct(none.alias("s"), none.alias("e"), none.alias("n")))))
    # posexplode_outer: a plain generator would make the optimizer infer size(b) > 0 and
    # push a copy of the whole sentence/UDF pipeline below the exchange as a filter
    rows = d.select(id_col, text_col, "sents", F.posexplode_outer("b").alias("chunk_no", "r"))
    cnt = F.col("r.e") - F.col("r.s") + 1
    whole = F.col("r.s").isNull()
    return rows.select(
        id_col, "chunk_no",
        F.col("r.s").alias("first_sent"), F.col("r.e").alias("last_sent"),
        F.when(whole, T.word_count(F.col(text_col))).otherwise(F.col("r.n")).alias("n_words"),
        F.when(whole, F.col(text_col))
        .otherwise(F.array_join(F.slice("sents", F.col("r.s") + 1, cnt), " ")).alias("chunk"))
