"""The hashing encoder: tokens are hashed once a batch, copies of a word are looked up."""

import hashlib
import re

import numpy as np
import pyarrow as pa

from sifter.operators import embedding as E

TEXTS = [(1, "One two two, Three! 4"), (2, None), (3, ""), (4, "Größe größe x'y"), (5, "...")]


def _vector(text, dim):
    v = np.zeros(dim)
    for t in re.findall(r"[^\W_]+", text.lower()):
        h = hashlib.md5(t.encode()).hexdigest()
        v[int(h[:8], 16) % dim] += 1 if h[8] < "8" else -1
    return v


def test_vectors_and_counts_by_hand(spark, params):
    df = spark.createDataFrame([*TEXTS, (1, "two more")], "id bigint, text string")
    for r in E.embed(df, params).collect():
        if r.text is None:
            assert r.emb is None
            continue
        v = _vector(r.text, params.embedding_dim)
        assert np.array_equal(np.float32(r.emb), np.float32(v / max(np.sqrt((v * v).sum()), 1e-300)))
    got = {(r.id, r.bucket): (r.cnt, r.weight) for r in E.hashed_counts(df, "id", params).collect()}
    for i, text in [(1, TEXTS[0][1] + " two more"), (4, TEXTS[3][1])]:  # rows of one id are added up
        v = _vector(text, params.embedding_dim)
        assert {b: c for (k, b), (c, _) in got.items() if k == i} == {int(b): int(v[b]) for b in np.flatnonzero(v)}
        assert all(w == np.float32(c / np.sqrt((v * v).sum())) for (k, _), (c, w) in got.items() if k == i)
    assert {k for k, _ in got} == {1, 4}


def test_hashing_is_not_done_twice_nor_by_token(spark, params):
    df = spark.createDataFrame(TEXTS, "id bigint, text string")
    plan = E.hashed_counts(df, "id", params)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "md5" not in plan and "Join" not in plan


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(E, "WORDS_KNOWN", 10)
    known = E._Buckets(384)
    first = [known[f"w{i}"] for i in range(25)]
    assert len(known) <= 10 and first == [known[f"w{i}"] for i in range(25)]


def test_null_lists_between_others():
    cells, signs = E.signed_cells(pa.array([[1, -3], None, [], [0]], pa.list_(pa.int32())), 4)
    assert cells.tolist() == [1, 2, 12] and signs.tolist() == [1.0, -1.0, 1.0]
