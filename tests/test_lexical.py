import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sifter.operators import lexical as L


def tfidf_cosine_direct(a: str, b: str) -> float:
    """Two-document TF-IDF (smooth idf, 1-3 grams of >=2-char word runs, l2 norm) by hand."""
    import re

    def grams(s):
        t = re.findall(r"[^\W]{2,}", s)
        return Counter(t + [" ".join(t[i:i + 2]) for i in range(len(t) - 1)]
                       + [" ".join(t[i:i + 3]) for i in range(len(t) - 2)])

    ga, gb = grams(a), grams(b)
    vocab = set(ga) | set(gb)
    idf = {w: math.log(3 / (1 + (w in ga) + (w in gb))) + 1 for w in vocab}
    va = {w: ga[w] * idf[w] for w in ga}
    vb = {w: gb[w] * idf[w] for w in gb}
    na = math.sqrt(sum(x * x for x in va.values()))
    nb = math.sqrt(sum(x * x for x in vb.values()))
    if na == 0 or nb == 0:
        return 0.0
    return sum(va[w] * vb.get(w, 0.0) for w in va) / (na * nb)


TEXTS = [
    (1, "student learn nlp data science"),
    (2, "data science student data science"),
    (3, "nothing common here"),
    (4, "student learn nlp data science"),
    (5, "o'clock tower bell rang o'clock"),
]


@pytest.fixture
def proc(spark):
    return spark.createDataFrame(TEXTS, "id bigint, processed string")


def test_tfidf_matches_direct(spark, params, proc):
    q = proc.withColumnRenamed("id", "q")
    d = proc.withColumnRenamed("id", "d")
    got = {(r.q, r.d): r.lex for r in
           L.tfidf_similarity(L.term_counts(q, "q"), L.term_counts(d, "d"), "q", "d", params).collect()}
    texts = dict(TEXTS)
    for a in texts:
        for b in texts:
            want = tfidf_cosine_direct(texts[a], texts[b])
            assert got.get((a, b), 0.0) == pytest.approx(want, abs=1e-12)
    assert got[(1, 4)] == 1.0 and got[(1, 1)] == 1.0  # self / copy similarity
    assert got[(1, 2)] == pytest.approx(got[(2, 1)])  # symmetric


def test_minhash_close_to_jaccard(spark, params, proc):
    q = proc.withColumnRenamed("id", "q")
    d = proc.withColumnRenamed("id", "d")
    mh = {(r.q, r.d): r.mh for r in L.minhash_similarity(
        L.minhash_signatures(q, "q", params), L.minhash_signatures(d, "d", params), "q", "d", params).collect()}
    jc = {(r.q, r.d): r.jaccard for r in L.jaccard_similarity(q, d, "q", "d", params).collect()}
    assert mh[(1, 4)] == 1.0 and jc[(1, 4)] == 1.0
    for key, j in jc.items():
        assert abs(mh.get(key, 0.0) - j) <= 3 * math.sqrt(max(j * (1 - j), 1e-4) / 128) + 0.02


def test_pair_scores_degenerate(spark, params):
    a = spark.createDataFrame([(1, ""), (2, "alpha beta"), (3, "")], "a_id bigint, processed string")
    b = spark.createDataFrame([(10, ""), (11, "alpha beta"), (12, "gamma")], "b_id bigint, processed string")
    pairs = spark.createDataFrame([(1, 10), (1, 11), (2, 11), (2, 12), (3, 12)], "a_id bigint, b_id bigint")
    got = {(r.a_id, r.b_id): (r.lex, r.mh) for r in L.pair_lexical_scores(pairs, a, b, params).collect()}
    assert got[(1, 10)] == (0.0, 1.0)  # both without tokens: MinHash 1, TF-IDF 0
    assert got[(1, 11)] == (0.0, 0.0)  # one without tokens
    assert got[(2, 11)] == (1.0, 1.0)
    assert got[(2, 12)][0] == 0.0


def test_minhash_empty_marker(spark, params):
    q = spark.createDataFrame([(1, ""), (2, "alpha beta")], "q bigint, processed string")
    d = spark.createDataFrame([(10, ""), (11, "alpha beta"), (12, "gamma")], "d bigint, processed string")
    qs, ds = L.minhash_signatures(q, "q", params), L.minhash_signatures(d, "d", params)
    marked = {(r.q, r.d): r.mh for r in L.minhash_similarity(qs, ds, "q", "d", params, mark_empty=True).collect()}
    assert marked == {(1, 10): 1.0, (2, 11): 1.0}
    plain = {(r.q, r.d): r.mh for r in L.minhash_similarity(qs, ds, "q", "d", params).collect()}
    assert plain == {(2, 11): 1.0}


def test_lemma_dictionary(spark, params):
    docs = spark.createDataFrame([(1, "Students are learning NLP and data science"), (2, "the and")],
                                 "id bigint, text string")
    dic = spark.createDataFrame([("learning", "learn"), ("data", "datum"), ("science", "science")],
                                "token string, lemma string")
    got = {r.id: r.processed for r in L.processed_with_dictionary(docs, "id", dic, params).collect()}
    assert got == {1: "student learn nlp datum science", 2: ""}


def test_jaccard_preprocesses_each_side_once(spark, params):
    q = L.with_processed(spark.createDataFrame([(1, "red river stones"), (2, None), (3, "")], "q long, text string"), params)
    d = L.with_processed(spark.createDataFrame([(7, "red river red banks"), (8, "river"), (9, None), (10, "the")], "d long, text string"), params)
    j = L.jaccard_similarity(q.select("q", "processed"), d.select("d", "processed"), "q", "d", params)
    assert {(r.q, r.d): (r.shared, round(r.jaccard, 9)) for r in j.collect()} == {(1, 7): (2, 0.5), (1, 8): (1, round(1 / 3, 9))}
    assert j._jdf.queryExecution().optimizedPlan().toString().count("array_distinct") == 2
