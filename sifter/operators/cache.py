"""Content-addressed embedding cache (E4-E7) as a Parquet table partitioned by model.

Key = (model, sha256 of the UTF-8 text). The model id includes the encoder
parameters, so two encoder variants never share entries. A lookup is two joins:
hits are an inner join with the cache, misses a ``left_anti`` join after
de-duplicating keys (each distinct text is encoded once per call). Fresh vectors
are appended with ``mode("append")``; entries never expire.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TT

from sifter.functions import text as T
from sifter.operators.embedding import VECTOR, embed_column
from sifter.params import Params

CACHE_SCHEMA = TT.StructType([
    TT.StructField("text_sha256", TT.StringType(), False),
    TT.StructField("emb", VECTOR, True),
    TT.StructField("model", TT.StringType(), False),
])


def model_id(params: Params, encoder_name: str | None = None) -> str:
    """The cache namespace of an encoder and its parameters."""
    return f"{encoder_name or params.encoder_id}:d{params.embedding_dim}"


def content_keys(df: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """Adds ``text_sha256`` and ``cache_key = emb:{model}:{sha256}``."""
    sha = T.content_sha256(F.col(text_col))
    return df.withColumn("text_sha256", sha).withColumn(
        "cache_key", F.concat(F.lit(f"emb:{model}:"), F.col("text_sha256")))


def read_cache(spark: SparkSession, path: str, model: str) -> DataFrame:
    """The cache rows of one model (partition pruning on ``model``); empty if absent."""
    try:
        cache = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)  # no table yet
    return cache.where(F.col("model") == model)


def split_hits(keyed: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """E5: (hits with ``emb``, distinct missing keys with one text each); NULL texts are neither."""
    hits = keyed.join(cache.select("text_sha256", "emb"), "text_sha256", "inner")
    misses = (keyed.where(F.col("text").isNotNull()).select("text_sha256", "text").dropDuplicates(["text_sha256"])
              .join(cache.select("text_sha256"), "text_sha256", "left_anti"))
    return hits, misses


def one_entry_a_key(cache: DataFrame) -> DataFrame:
    """The cache without further entries of a key (writers that ran at once leave some). Keys alone are
    counted first: taking them out sorts all vectors, and most caches have none."""
    repeated = cache.groupBy("text_sha256").count().where("count > 1")
    return cache if repeated.isEmpty() else cache.dropDuplicates(["text_sha256"])


def embed_with_cache(df: DataFrame, params: Params, path: str, text_col: str = "text",
                     encoder: Callable[[list[str]], np.ndarray] | None = None,
                     encoder_name: str | None = None) -> DataFrame:
    """E1+E5+E6: embeddings of ``df[text_col]`` reading and filling the cache at ``path``.

    Writes the misses first (an action), then returns every input row with ``emb``
    joined from the cache table, so downstream work reads stored vectors and the
    encoder never runs twice for one text.
    """
    spark = df.sparkSession
    model = model_id(params, encoder_name)
    keyed = content_keys(df.withColumnRenamed(text_col, "text") if text_col != "text" else df, model)
    cache = read_cache(spark, path, model)
    _, misses = split_hits(keyed, cache)
    fresh = misses.select("text_sha256", embed_column(F.col("text"), params, encoder).alias("emb"),
                          F.lit(model).alias("model"))
    fresh.write.mode("append").partitionBy("model").parquet(path)
    out = keyed.join(one_entry_a_key(read_cache(spark, path, model)).select("text_sha256", "emb"), "text_sha256", "left")
    if text_col != "text":
        out = out.withColumnRenamed("text", text_col)
    return out
