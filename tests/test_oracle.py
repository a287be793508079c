"""Every registered query against its DuckDB statement on the smallest fixture."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sifter.catalog import QUERIES
from sifter.catalog_sql import oracle_sql

TABLES = "documents embeddings pages benchmark labels conversations".split()
NO_ORACLE = {"vector_topk_lsh", "vector_topk_ivf", "passage_fragments", "svd_embedding"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def rows(cols, it):
    return sorted((tuple(("nan" if isinstance(v, float) and math.isnan(v) else v) for v in r) for r in it), key=repr)


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) - set(oracle_sql()) == NO_ORACLE


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = rows(cols, (tuple(r[c] for c in cols) for r in sdf.collect()))
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = rows(cols, (tuple(r[i] for i in idx) for r in rel.fetchall()))
    assert len(got) == len(want)
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"item_id", "doc_id", "final_score", "level", "rank"} <= set(df.columns)


FALLBACK = ["tfidf_pair_similarity", "minhash_similarity", "vector_topk", "doc_semantic_similarity",
            "corpus_semantic_hits", "analyze_corpus", "analyze_pairs"]


@pytest.mark.parametrize("name", FALLBACK)
def test_no_broadcast_paths_match_oracle(spark, con, name, monkeypatch):
    """Past the broadcast bounds the joins shuffle and kNN runs on the multi-block grid."""
    from dataclasses import replace

    import sifter.catalog as C
    monkeypatch.setattr(C, "P", replace(C.P, broadcast_max_rows=0, broadcast_max_bytes=0, block_rows=60))
    test_query_matches_oracle(spark, con, name)
