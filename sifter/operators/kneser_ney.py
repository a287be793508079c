"""D1 with a better model: interpolated Kneser-Ney trigrams, counted and smoothed by Spark.

A word's lower-order weight is the number of different words it follows, not how often it
occurs. Each order's discount comes from its counts of counts. The model is kept as counts of
trigrams and pairs and a sum and back-off weight of every context, none of which needs a join;
a scored trigram is looked up and its orders are put together by left joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.operators.aiscore import lm_tokens
from sifter.operators.common import bounded_broadcast, written
from sifter.params import Params

#: Stands twice before every text; no token looks like it.
START = "<s>"
#: A discount's least value, and its value where no count of counts tells.
LEAST_DISCOUNT, DEFAULT_DISCOUNT = 0.1, 0.5


@dataclass(frozen=True)
class KneserNey:
    """Counts and back-off weights: trigrams (u, v, w, n3), contexts (u, v, sum3, b3), pairs (v, w, n2),
    words (v, sum2, b2), unigrams (w, p1), the discounts ``d3`` and ``d2`` and the probability of an
    unseen word."""

    trigrams: DataFrame
    contexts: DataFrame
    pairs: DataFrame
    words: DataFrame
    unigrams: DataFrame
    d3: float
    d2: float
    unseen: float


def trigrams(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, u, v, w, n) of every row, one for each token."""

    def grams(t: Column) -> Column:
        s = F.concat(F.array(F.lit(START), F.lit(START)), t)
        return F.arrays_zip(F.slice(s, F.lit(1), F.size(t)).alias("u"), F.slice(s, F.lit(2), F.size(t)).alias("v"), t.alias("w"))

    # the tokens are let-bound, so each text is cut once
    rows = df.select(*keys, F.explode_outer(F.transform(F.array(lm_tokens(F.col(text))), grams)[0]).alias("g"))
    u, v, w = (F.col("g").getField(i).alias(i) for i in "uvw")
    return rows.where(F.col("g").isNotNull()).select(*keys, u, v, w).groupBy(*keys, "u", "v", "w").agg(F.count(F.lit(1)).alias("n"))


def _discount(one: int, two: int) -> float:
    return max(LEAST_DISCOUNT, one / (one + 2 * two)) if one + two else DEFAULT_DISCOUNT


def _counts_of_counts(counts: DataFrame, n: str) -> tuple[int, int, int, int]:
    """Rows with a count of 1 and of 2, all rows, and the sum of counts."""
    return counts.agg(F.count_if(F.col(n) == 1), F.count_if(F.col(n) == 2), F.count(F.lit(1)), F.coalesce(F.sum(n), F.lit(0))).first()


def _contexts(counts: DataFrame, context: list[str], n: str, d: float, total: str, back: str) -> DataFrame:
    sums = counts.groupBy(*context).agg(F.sum(n).alias(total), F.count(F.lit(1)).alias("_kinds"))
    return sums.select(*context, total, (F.lit(d) * F.col("_kinds") / F.col(total)).alias(back))


def fit(train: DataFrame, params: Params, text: str = "text") -> KneserNey:
    """Counts, continuation counts and back-off weights of ``train``'s texts; null and token-less
    texts add nothing. A model of an empty table gives every word the same probability.

    Trigrams and pairs are counted once and written to the shared folder, so the texts are cut and
    shuffled once whatever reads the counts."""
    c3 = written(trigrams(train, [], text).withColumnRenamed("n", "n3"), "kneser-ney-trigrams")
    # different words before each pair
    c2 = written(c3.groupBy("v", "w").agg(F.count(F.lit(1)).alias("n2")), "kneser-ney-pairs")
    c1 = written(c2.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "kneser-ney-words")
    one, two, kinds, total = _counts_of_counts(c1, "n")
    d1 = _discount(one, two)
    d2, d3 = (_discount(*_counts_of_counts(c, n)[:2]) for c, n in ((c2, "n2"), (c3, "n3")))
    unseen = d1 * kinds / total / (kinds + 1) if total else 1.0
    unigrams = c1.select("w", ((F.col("n") - d1) / F.lit(max(1, total)) + F.lit(unseen)).alias("p1"))
    return KneserNey(c3, _contexts(c3, ["u", "v"], "n3", d3, "sum3", "b3"), c2, _contexts(c2, ["v"], "n2", d2, "sum2", "b2"),
                     unigrams, d3, d2, float(unseen))


def probabilities(rows: DataFrame, model: KneserNey, params: Params) -> DataFrame:
    """Adds ``p`` to rows with u, v and w: the discounted share of the trigram, of the pair and the
    word's probability, each weighted by the back-off before it. The tables with a row a word are
    broadcast when they are small, as their keys are the hot ones. The rows are written after each
    of the large joins, so the shuffle files of one are gone before the next."""
    words, unigrams = (bounded_broadcast(t, params.broadcast_max_rows)[0] for t in (model.words, model.unigrams))
    found = written(rows.join(model.trigrams, ["u", "v", "w"], "left"), "kneser-ney-scored")
    found = written(found.join(model.contexts, ["u", "v"], "left"), "kneser-ney-scored")
    found = found.join(model.pairs, ["v", "w"], "left").join(words, "v", "left").join(unigrams, "w", "left")

    def own(n: str, d: float, total: str) -> Column:
        return F.coalesce((F.col(n) - F.lit(d)) / F.col(total), F.lit(0.0))

    p2 = own("n2", model.d2, "sum2") + F.coalesce("b2", F.lit(1.0)) * F.coalesce("p1", F.lit(model.unseen))
    p = own("n3", model.d3, "sum3") + F.coalesce("b3", F.lit(1.0)) * p2
    return found.select(*rows.columns, p.alias("p"))


def perplexity(df: DataFrame, keys: list[str], model: KneserNey, params: Params, text: str = "text") -> DataFrame:
    """``keys`` and ``perplexity`` = exp(-mean log p) over a row's tokens, null without tokens.
    Keys are unique and not null."""
    scored = probabilities(trigrams(df, keys, text), model, params)
    mean = scored.groupBy(*keys).agg((F.sum(F.col("n") * F.log("p")) / F.sum("n")).alias("_m"))
    return df.select(*keys).join(mean, keys, "left").select(*keys, F.exp(-F.col("_m")).alias("perplexity"))
