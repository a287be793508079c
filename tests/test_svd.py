"""Randomised SVD of the term matrix against numpy's."""

import numpy as np
import pytest

from conftest import SF_SMALL
from sifter.operators import svd

TERMS = 4096


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(5)


@pytest.fixture(scope="module")
def model(docs):
    return svd.fit(docs, "doc_id", dim=16, terms=TERMS)


def dense(docs):
    """The matrix by the definition, one Python dictionary a text."""
    import hashlib

    import regex
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    a = np.zeros((len(rows), TERMS))
    for i, (_, text) in enumerate(rows):
        for token in regex.findall(r"[\p{L}\p{N}]+", text.lower()):
            h = hashlib.md5(token.encode()).hexdigest()
            a[i, int(h[:8], 16) % TERMS] += 1 if h[8] in "01234567" else -1
    idf = np.log((1 + len(a)) / (1 + (a != 0).sum(axis=0))) + 1
    a = np.sign(a) * np.log1p(np.abs(a)) * idf
    norm = np.linalg.norm(a, axis=1, keepdims=True)
    return [i for i, _ in rows], a / np.where(norm > 0, norm, 1)


def test_subspace_equals_numpy(docs, model):
    _, a = dense(docs)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(model.values, s[:16], rtol=0.01)
    assert np.allclose(model.basis.T @ model.basis, np.eye(16), atol=1e-8)
    # the leading directions agree, and the whole subspace holds as much of the matrix as the best one
    assert np.linalg.svd(vt[:4] @ model.basis)[1].min() > 0.99
    assert np.linalg.norm(a @ model.basis) ** 2 >= 0.995 * (s[:16] ** 2).sum()


def test_encode_is_row_times_basis(docs, model):
    ids, a = dense(docs)
    want = a @ model.basis
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    got = {r.doc_id: r.emb for r in svd.encode(docs, "doc_id", model).collect()}
    assert sorted(got) == ids
    assert np.allclose([got[i] for i in ids], want, atol=1e-5)


def test_partitions_do_not_matter(docs, model):
    one = svd.fit(docs.coalesce(1), "doc_id", dim=16, terms=TERMS)
    assert np.allclose(one.values, model.values, atol=1e-8)
    assert np.allclose(np.abs(np.sum(one.basis * model.basis, axis=0)), 1, atol=1e-4)


def test_model_is_an_encoder_of_corpus_mode(spark, docs, model, params):
    from sifter.plans.analysis import compare_corpus

    texts = [r.text for r in docs.orderBy("doc_id").limit(20).collect()]
    native = [r.emb for r in svd.encode(docs.orderBy("doc_id").limit(20), "doc_id", model).orderBy("doc_id").collect()]
    assert np.allclose(model(texts), native, atol=1e-6)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    top = compare_corpus(bench, docs, "item_id", "doc_id", params, encoder=model, top_n=3)
    assert top.count() == 3 * bench.count()


def test_nulls_empty_texts_long_texts_and_empty_tables(spark, model):
    long = "word other " * 200_000
    rows = [(1, None, "x"), (2, "", "x"), (3, "?!", "x"), (4, "alpha beta", "x"), (4, "alpha beta", "x"), (5, long, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, cols string")
    got = [(r.doc_id, r.emb) for r in svd.encode(df, "doc_id", model).collect()]
    assert sorted(i for i, _ in got) == [1, 2, 3, 4, 4, 5]
    by_id = dict(got)
    assert by_id[1] is None and not any(by_id[2]) and not any(by_id[3])
    small = svd.fit(df, "doc_id", dim=3, terms=64)
    assert np.linalg.matrix_rank(small.basis) == 2  # rank of the table: two distinct directions
    empty = svd.fit(df.limit(0), "doc_id", dim=3, terms=64)
    assert not empty.basis.any()
    assert not np.any([r.emb for r in svd.encode(df.where("doc_id = 4"), "doc_id", empty).collect()])
