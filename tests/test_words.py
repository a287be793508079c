"""T1-T7, n-gram counts and signatures by distinct words equal the native expressions."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from sifter.functions import hashing
from sifter.functions import text as T
from sifter.functions import words as W
from sifter.operators import embedding as E
from sifter.operators import lexical as L

ODD = ["", "'''", "KELVIN KİNG's o'clock's 'tis dogs' x's' y''s zz aaa\u0085bbb ccc　d​d ééé\tfoo\x1cbar\x0bbaz﻿qux",
       "flies classes running sing bed shed boxes bus gas", "x1y2 snake_case 123 ٣٤ 日本 naïve one, two one two one",
       "ΑΣ ﬃ ß ſtone Ⱥ ² ¼ x́y", None, "the of", "red red " * 400]


def frame(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "id bigint, text string")


def test_preprocessing_equals_the_expressions(spark, params):
    df = L.with_processed(frame(spark), params).withColumn("native", T.preprocess(F.col("text"), params))
    assert all(r.processed == r.native for r in df.collect())
    plan = L.with_processed(frame(spark), params)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan  # no regular expression for each character of a corpus


def test_counts_equal_a_row_a_token(spark, params, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_TOKENS", 7)
    rows = frame(spark).union(spark.createDataFrame([(4, "one two"), (None, "one two")], "id bigint, text string"))
    src = rows.select("id", F.lower("text").alias("processed"))
    grams = src.select("id", F.explode_outer(T.ngrams_1_3(T.tfidf_tokens(F.col("processed")))).alias("term")).where("term is not null")
    want = sorted((r.id or -1, r.term, r.tf) for r in grams.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")).collect())
    assert sorted((r.id or -1, r.term, r.tf) for r in L.term_counts(src, "id").collect()) == want
    some = spark.createDataFrame([("one two",), ("red red red",), ("absent",)], "term string")
    got = L.term_counts(src, "id", among=some, totals=True).collect()
    total = {i: sum(n * n for k, _, n in want if k == i) for i, _, _ in want}
    assert sorted((r.id or -1, r.term, r.tf, r.total) for r in got) == [(*w, total[w[0]]) for w in want if w[1] in ("one two", "red red red")]
    plan = L.term_counts(src, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no row a token


def test_signatures_by_hand(spark, params, monkeypatch):
    monkeypatch.setattr(W, "SLOT_WORDS", 3)
    src = frame(spark).select("id", F.col("text").alias("processed"))
    coeffs = np.array(hashing.minhash_coefficients(params.minhash_perms, params.minhash_seed), dtype=np.int64)
    for r in L.minhash_signatures(src, "id", params).collect():
        words = set((ODD[r.id] or "").split())
        h = np.array([int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in words], np.int64)
        assert r.n_tokens == len(words)
        assert r.sig == (((coeffs[:, :1] * h + coeffs[:, 1:]) % hashing.MERSENNE_31).min(axis=1).tolist() if words else None)


def test_slot_values_are_forgotten_when_full(params, monkeypatch):
    monkeypatch.setattr(W, "WORDS_KNOWN", 8)
    slots, words = W.SlotValues(params), [f"w{i}" for i in range(30)]
    monkeypatch.setattr(W, "SLOT_WORDS", 5)
    want = W.SlotValues(params)
    one = np.min([want.values[want.places([w])][0] for w in words], axis=0)
    assert (slots.signature(words) == one).all() and len(slots.at) <= 8


def test_latin_and_other_texts_have_the_same_tokens(spark, params):
    df = frame(spark).select(E.signed_buckets(F.col("text"), 64).alias("got"),
                             F.regexp_extract_all(F.lower("text"), F.lit(T.VECTOR_TOKEN_RE), 0).alias("tokens"))
    for r in df.collect():
        known = E._Buckets(64)
        assert r.got == (None if r.tokens is None else [known[t] for t in r.tokens])


def test_strip_is_pythons(spark):
    every = [chr(i) for i in range(1, 0x3002) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(c + "a" + c + "b" + c,) for c in every], "s string")
    assert [r[0] for r in df.select(T.strip(F.col("s"))).collect()] == [(c + "a" + c + "b" + c).strip() for c in every]
