"""Machine-written-text score.

Perplexity comes from a word bigram language model counted over a training
table (add-k smoothing, one extra vocabulary slot for unseen words), so the model
is itself a Spark aggregate and scales with its training set. A neural scorer
can replace it: any frame ``(id, perplexity)`` can be passed to ``ai_score``.
Burstiness is computed from each row's sentence word counts with array
aggregates (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions import text as T
from sifter.params import Params

EPS = 1e-9


def lm_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(T.VECTOR_TOKEN_RE), 0)


def bigrams(df: DataFrame, id_col: str, params: Params, text_col: str = "text") -> DataFrame:
    """``(id, w1, w2, n)``: bigram occurrences per row, pre-aggregated per row."""
    toks = df.select(id_col, lm_tokens(F.col(text_col)).alias("t"))
    n1 = F.greatest(F.size("t") - 1, F.lit(0))
    pairs = toks.select(id_col, F.explode_outer(F.arrays_zip(F.slice("t", 1, n1).alias("w1"),
                                                             F.slice("t", 2, n1).alias("w2"))).alias("p"))
    return (pairs.where(F.col("p").isNotNull())
            .groupBy(id_col, F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2"))
            .agg(F.count(F.lit(1)).alias("n")))


class BigramModel:
    """Counts of a bigram model: ``pairs (w1, w2, c12)``, ``contexts (w1, c1)``, vocabulary size."""

    def __init__(self, pairs: DataFrame, contexts: DataFrame, vocab: int, add_k: float):
        self.pairs, self.contexts, self.vocab, self.add_k = pairs, contexts, vocab, add_k


def fit_bigram_model(train: DataFrame, params: Params, text_col: str = "text") -> BigramModel:
    """D1 model: counted with partial aggregation; the vocabulary size is one scalar."""
    toks = train.select(lm_tokens(F.col(text_col)).alias("t"))
    n1 = F.greatest(F.size("t") - 1, F.lit(0))
    pairs = (toks.select(F.explode_outer(F.arrays_zip(F.slice("t", 1, n1).alias("w1"),
                                                      F.slice("t", 2, n1).alias("w2"))).alias("p"))
             .where(F.col("p").isNotNull())
             .groupBy(F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2"))
             .agg(F.count(F.lit(1)).alias("c12")))
    contexts = pairs.groupBy("w1").agg(F.sum("c12").alias("c1"))
    vocab = toks.select(F.explode_outer("t").alias("w")).agg(F.countDistinct("w").alias("v")).first()["v"]
    return BigramModel(pairs, contexts, int(vocab or 0) + 1, params.lm_add_k)


def perplexity(df: DataFrame, id_col: str, model: BigramModel, params: Params,
               text_col: str = "text") -> DataFrame:
    """``(id, perplexity)`` = exp(-mean log p(w2|w1)); NULL for rows under 2 tokens."""
    bg = bigrams(df, id_col, params, text_col)
    k = F.lit(float(model.add_k))
    kv = F.lit(float(model.add_k) * model.vocab)
    scored = (bg.join(model.pairs, ["w1", "w2"], "left").join(model.contexts, "w1", "left")
              .select(id_col, "n",
                      F.log((F.coalesce(F.col("c12"), F.lit(0)).cast("double") + k)
                            / (F.coalesce(F.col("c1"), F.lit(0)).cast("double") + kv)).alias("lp")))
    agg = scored.groupBy(id_col).agg((F.sum(F.col("n") * F.col("lp")) / F.sum("n")).alias("mlp"))
    return (df.select(id_col).join(agg, id_col, "left")
            .select(id_col, F.exp(-F.col("mlp")).alias("perplexity")))


def burstiness(text: Column) -> Column:
    """Population std / (mean + 1e-9) of sentence word counts; 0.0 under 2 sentences.

    The word-count array and its mean are let-bound (``transform(array(v), f)[0]``)
    so each is computed once per row, not once per element of the inner lambda."""
    wc = F.transform(T.sentences(text), lambda s: T.word_count(s).cast("double"))
    return F.transform(F.array(wc), _burst)[0]


def _burst(wc: Column) -> Column:
    n = F.size(wc).cast("double")
    mean = F.aggregate(wc, F.lit(0.0), lambda a, x: a + x) / n

    def from_mean(m: Column) -> Column:
        var = F.aggregate(wc, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / n
        return F.sqrt(var) / (m + F.lit(EPS))

    return F.when(F.size(wc) < 2, F.lit(0.0)).otherwise(F.transform(F.array(mean), from_mean)[0])


def ai_score(df: DataFrame, id_col: str, ppl: DataFrame, params: Params, text_col: str = "text") -> DataFrame:
    """D3+D4: ``(id, perplexity, burstiness, ai_probability, ai_label)``; perplexity rounded to 1,
    the rest to 3; the label tests the unrounded score."""
    b = df.select(id_col, burstiness(F.col(text_col)).alias("b"))
    raw = T.clamp01((F.lit(1.0) - F.col("perplexity") / F.lit(float(params.ai_ppl_scale))) * F.lit(0.6)
                    + (F.lit(1.0) - F.col("b")) * F.lit(0.4))
    ai, human = params.ai_labels
    return (b.join(ppl, id_col, "left")
            .select(id_col, F.round("perplexity", 1).alias("perplexity"),
                    F.round("b", 3).alias("burstiness"),
                    F.round(raw, 3).alias("ai_probability"),
                    F.when(raw.isNull(), F.lit(None).cast("string"))
                    .when(raw > F.lit(float(params.ai_threshold)), F.lit(ai)).otherwise(F.lit(human))
                    .alias("ai_label")))
