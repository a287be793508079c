"""Pair mode's fragment search and re-ranking: no group a pair, and a scorer that runs once a fragment."""

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from sifter.operators import scoring as S


def _chunks(spark, key, sizes, seed):
    rng, rows = np.random.default_rng(seed), []
    for i, n in sizes.items():
        for no in range(n):
            v = rng.normal(size=6) + 1.0
            rows.append((i, no, f"chunk {i} {no}", [float(x) for x in v / np.linalg.norm(v)]))
    rows.append((max(sizes), 99, "no vector", None))
    return spark.createDataFrame(rows, f"{key} bigint, chunk_no int, chunk string, emb array<float>")


def test_similar_fragments_without_a_group_a_pair(spark, params):
    a, b = _chunks(spark, "a_id", {1: 3, 2: 40, 5: 1}, 1), _chunks(spark, "b_id", {7: 30, 8: 1, 9: 70}, 2)
    pairs = spark.createDataFrame([(1, 7), (2, 7), (2, 9), (5, 8), (5, 9), (6, 7), (1, 10)], "a_id bigint, b_id bigint")
    found = S.similar_fragments(pairs, a, b, params)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan  # one Python group a pair: time by pairs, memory by groups
    grid = S.similar_fragments(pairs, a, b, replace(params, broadcast_max_rows=0))
    got, want = sorted(map(tuple, found.collect())), sorted(map(tuple, grid.collect()))
    assert [g[:5] for g in got] == [w[:5] for w in want] and len(got) > 500
    assert np.allclose([g[5] for g in got], [w[5] for w in want], atol=1e-11)
    assert found.schema == grid.schema
    av, bv = ({(r[0], r.chunk_no): np.array(r.emb) for r in df.collect() if r.emb} for df in (a, b))
    for a_id, b_id in [(1, 7), (2, 9)]:
        for (i, no), v in av.items():
            if i == a_id:
                best = sorted(((-round(float(v @ w), 12), k) for (j, k), w in bv.items() if j == b_id and v @ w > 0.5))[:20]
                assert [k for _, k in best] == [g[3] for g in sorted(got, key=lambda g: g[4]) if g[:3] == (a_id, b_id, no)]


def test_scorer_runs_once_a_fragment(spark, params):
    a, b = _chunks(spark, "a_id", {1: 2}, 1), _chunks(spark, "b_id", {7: 2}, 2)
    frags = spark.createDataFrame([(1, 7, 0, 1, 1, 0.9)], "a_id bigint, b_id bigint, a_chunk int, b_chunk int, hit_rank int, cosine double")
    f = S.rerank_fragments(frags, a, b, params, S.token_jaccard_scorer)
    top = S.top_fragments(f, params).select("a_id", "score")
    assert top._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 2  # once a text
    assert [r.score for r in top.collect()] == [0.5]  # {chunk, 1, 0} and {chunk, 7, 1}: 2 of 4


def test_token_jaccard(spark):
    rows = [("a b", "B c"), ("", "!"), ("x", "x x"), (None, "a"), ("", "a")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(S.token_jaccard_scorer(F.col("a"), F.col("b"))).collect()]
    assert got == [1 / 3, 0.0, 1.0, None, 0.0]
