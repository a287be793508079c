"""Fragments, blending and ranking."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TT

from sifter.functions import text as T
from sifter.operators import vectors as V
from sifter.operators.common import written
from sifter.params import Params
from sifter.session import ensure_workers

# --------------------------------------------------------------------------- A3 / A4

def blend(lex: Column, mh: Column, sem: Column, params: Params) -> Column:
    """A3: weighted sum of the unrounded parts, rounded to 3."""
    return F.round(F.lit(params.weight_tfidf) * lex + F.lit(params.weight_minhash) * mh
                   + F.lit(params.weight_semantic) * sem, 3)


def level(score: Column, params: Params) -> Column:
    """A4: on the rounded score; the boundaries themselves fall in the lower level."""
    hi, mid, lo = params.level_labels
    return (F.when(score > F.lit(params.level_high), F.lit(hi))
            .when(score > F.lit(params.level_medium), F.lit(mid)).otherwise(F.lit(lo)))


# --------------------------------------------------------------------------- A1 / A2

def chunk_hits(q_chunks: DataFrame, d_chunks: DataFrame, q_id: str, d_id: str,
               params: Params) -> DataFrame:
    """A1: each query chunk searches the whole corpus chunk index (top ``corpus_search_k``);
    hits are grouped per (query, corpus doc) -> ``(q_id, d_id, hit_mean, n_hits)``."""
    left = q_chunks.select(q_id, F.col("chunk_no").alias("q_chunk"), "emb")
    right = d_chunks.select(d_id, F.col("chunk_no").alias("d_chunk"), "emb")
    hits = V.topk_similar(left, right, (q_id, "q_chunk"), (d_id, "d_chunk"), params.corpus_search_k, params)
    return (hits.groupBy(q_id, d_id)
            .agg(F.avg("score").alias("hit_mean"), F.count(F.lit(1)).alias("n_hits")))


def doc_cosines(q_docs: DataFrame, d_docs: DataFrame, q_id: str, d_id: str, params: Params) -> DataFrame:
    """V5 for every (query, corpus doc): whole-document cosine ``(q_id, d_id, doc_cos)``.

    This is the dense frame of corpus mode (every corpus document gets a row per
    query); it comes out of the blocked matrix product, not from a pair join."""
    return (V.topk_similar(q_docs.select(q_id, "emb"), d_docs.select(d_id, "emb"), q_id, d_id, None, params)
            .select(q_id, d_id, F.col("score").alias("doc_cos")))


# --------------------------------------------------------------------------- F1-F3

def similar_fragments(pairs: DataFrame, a_chunks: DataFrame, b_chunks: DataFrame,
                      params: Params) -> DataFrame:
    """for every pair ``(a_id, b_id)``, each chunk of A against the top
    ``pair_search_k`` chunks of B, kept when the cosine is strictly above
    ``fragment_threshold`` -> ``(a_id, b_id, a_chunk, b_chunk, hit_rank, cosine)``.

    Chunk frames are ``(a_id|b_id, chunk_no, emb)``. The threshold comes before the ranking, which
    it cannot change: B's chunks stream past the broadcast chunks of A. When A is too large for
    that, the search runs per pair group on the similarity grid."""
    left = a_chunks.select("a_id", F.col("chunk_no").alias("a_chunk"), "emb")
    right = b_chunks.select("b_id", F.col("chunk_no").alias("b_chunk"), "emb")
    hits = V.scores_above(pairs, left, right, "a_chunk", "b_chunk", params.fragment_threshold, params)
    if hits is None:
        hits = V.topk_similar(pairs.join(left, "a_id"), pairs.join(right, "b_id"), "a_chunk", "b_chunk", params.pair_search_k,
                              params, group_cols=["a_id", "b_id"], min_score=params.fragment_threshold)
    else:
        w = Window.partitionBy("a_id", "b_id", "a_chunk").orderBy(F.col("score").desc(), "b_chunk")
        hits = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= params.pair_search_k)
    return hits.select("a_id", "b_id", F.col("a_chunk").cast("int").alias("a_chunk"),
                       F.col("b_chunk").cast("int").alias("b_chunk"),
                       F.col("rank").alias("hit_rank"), F.col("score").alias("cosine"))


def token_jaccard_scorer(a: Column, b: Column) -> Column:
    """A native pair scorer for F2: Jaccard of the distinct lower-cased word sets.

    The sets are bound in lists of one element, so that each is built once a pair."""
    ta = F.array_distinct(F.regexp_extract_all(F.lower(a), F.lit(T.VECTOR_TOKEN_RE), 0))
    tb = F.array_distinct(F.regexp_extract_all(F.lower(b), F.lit(T.VECTOR_TOKEN_RE), 0))
    sizes = F.transform(F.array(F.struct(ta.alias("a"), tb.alias("b"))), lambda s: F.struct(
        F.size(F.array_union(s["a"], s["b"])).alias("all"), F.size(F.array_intersect(s["a"], s["b"])).alias("both")))
    return F.transform(sizes, lambda n: F.when(n["all"] == 0, F.lit(0.0)).otherwise(n["both"] / n["all"]))[0]


def pandas_pair_scorer(fn: Callable[[list[str], list[str]], np.ndarray], batch_size: int = 64):
    """Wraps a model ``fn(texts_a, texts_b) -> scores`` (e.g. a cross-encoder) as an
    Arrow-batched pair scorer column function; 2-D outputs use column 0."""
    ensure_workers()
    @F.pandas_udf(TT.DoubleType())
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        la, lb = a.tolist(), b.tolist()
        for i in range(0, len(la), batch_size):
            s = np.asarray(fn(la[i:i + batch_size], lb[i:i + batch_size]), dtype=np.float64)
            out.append(s[:, 0] if s.ndim > 1 else s)
        return pd.Series(np.concatenate(out) if out else np.zeros(0))
    return lambda a, b: score(a, b)


def rerank_fragments(frags: DataFrame, a_chunks: DataFrame, b_chunks: DataFrame, params: Params,
                     scorer: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """F2: adds texts ``frag_a``/``frag_b`` and the final fragment ``score``.

    Without a scorer the cosine is kept (rounded to 3). With one, the scorer output
    divided by ``rerank_scale``, clamped and rounded to 3 replaces it (no second
    threshold)."""
    f = (frags.join(a_chunks.select("a_id", F.col("chunk_no").alias("a_chunk"), F.col("chunk").alias("frag_a")),
                    ["a_id", "a_chunk"])
         .join(b_chunks.select("b_id", F.col("chunk_no").alias("b_chunk"), F.col("chunk").alias("frag_b")),
               ["b_id", "b_chunk"]))
    if scorer is None:
        score = F.round(F.col("cosine"), 3)
    else:
        # a column of its own: the clamps name their argument twice, and the scorer would run for each
        f = f.withColumn("_raw", scorer(F.col("frag_a"), F.col("frag_b")))
        score = F.round(T.clamp01(F.col("_raw") / F.lit(float(params.rerank_scale))), 3)
    return f.withColumn("score", T.clamp01(score)).drop("_raw")


def top_fragments(scored: DataFrame, params: Params) -> DataFrame:
    """best ``fragments_kept`` per pair by score, ties in (A chunk, hit rank) order."""
    w = Window.partitionBy("a_id", "b_id").orderBy(F.col("score").desc(), "a_chunk", "hit_rank")
    return scored.withColumn("frag_rank", F.row_number().over(w)).where(F.col("frag_rank") <= params.fragments_kept)


def nest_fragments(top: DataFrame) -> DataFrame:
    """Pair -> ``fragments ARRAY<STRUCT<frag_doc1, frag_doc2, score>>`` in rank order."""
    return top.groupBy("a_id", "b_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("frag_rank", "frag_a", "frag_b", "score"))),
                    lambda x: F.struct(x["frag_a"].alias("frag_doc1"), x["frag_b"].alias("frag_doc2"),
                                       x["score"].alias("score"))).alias("fragments"))


def rank_top(df: DataFrame, part: str, score: str, tie: str, n: int) -> DataFrame:
    """Best ``n`` rows per ``part`` by ``score`` desc, ``tie`` asc (partial limit before
    the shuffle)."""
    w = Window.partitionBy(part).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def ordinal_rank(df: DataFrame, part: str, score: str, tie: str) -> DataFrame:
    """A6 without a per-group task: ``rank`` = 1-based position of each row within its
    ``part`` by ``score`` desc, ``tie`` asc, for groups of any size.

    A ``row_number()`` window would put all rows of a group (a query's whole corpus)
    in one task. Here the rows are range-partitioned and sorted on (part, score,
    tie); a row's rank is its offset inside its partition plus the number of rows of
    the same group in earlier partitions. The offsets come from a small aggregate
    (one row per group and partition; AQE broadcasts it at run time when small).

    The rows are written before they are sorted, as a range exchange runs its input once more to
    sample it. Partition ids and positions are frozen by writing the sorted rows (to the
    session's shared folder) before they are read twice: two separate range exchanges would each
    sample their own bounds, so the offsets could be computed on a different partitioning than
    the rows."""
    df = written(df, "scores")
    order = [F.col(part), F.col(score).desc(), F.col(tie)]
    s = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    stats = s.groupBy(part, "_pid").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    stats = stats.withColumn("_off", F.sum("_n").over(Window.partitionBy(part).orderBy("_pid")) - F.col("_n"))
    return (s.join(stats.select(part, "_pid", "_m0", "_off"), [part, "_pid"])
            .withColumn("rank", (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("long"))
            .drop("_pid", "_mid", "_m0", "_off"))
