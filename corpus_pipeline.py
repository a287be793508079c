"""The corpus pipeline: STAGES over ``documents``, each written and read by the next.

Every stage takes (spark, docs, sf_dir) and calls one operator of ``sifter.llm``; all but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm import bpe_lexicon, decontaminate, langid, pii, simhash
from sifter.llm.common import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no letters, or no language certain enough) go."""
    model = langid.train(docs, "text", "lang")
    return langid.identify(docs, model, "text", declared="lang", host="source").where("lang_ok").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays: the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % or more of a benchmark item's five-word shingles go."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets; n_chars follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids as little-endian 32-bit integers, their number, and the text
    decoded from them."""
    rows = bpe_lexicon.encode(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"], decode=True)
    return rows.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "decoded")


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("PII", redact_pii), ("BPE encoding and decoding", encode)]

#: Hash voting, trained models and tokenising have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k}-{name.replace(' ', '-')}")
    return docs
