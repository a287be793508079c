"""A third of the corpus is one group of exact copies (and a third of the vectors one vector):
the main queries must still match their SQL oracle exactly, ties among copies included."""

import math
import shutil
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = ["tfidf_pair_similarity", "minhash_similarity", "vector_topk", "corpus_semantic_hits",
           "analyze_corpus", "corpus_top10", "analyze_pairs"]


@pytest.fixture(scope="module")
def skewed(spark):
    d = tempfile.mkdtemp(prefix="sifter-skew-")
    for t in ("benchmark", "labels", "conversations"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{d}/{t}.parquet")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    n = docs.count()
    hot = docs.where(F.col("doc_id") == 0)
    copies = hot.withColumn("doc_id", F.explode(F.sequence(F.lit(100000), F.lit(100000 + n // 2 - 1))))
    docs.unionByName(copies.select(*docs.columns)).toPandas().to_parquet(f"{d}/documents.parquet")
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    m = emb.count()
    hot_v = emb.where(F.col("vec_id") == 0)
    vcopies = hot_v.withColumn("vec_id", F.explode(F.sequence(F.lit(100000), F.lit(100000 + m // 2 - 1))))
    emb.unionByName(vcopies.select(*emb.columns)).toPandas().to_parquet(f"{d}/embeddings.parquet")
    return d


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_matches_oracle(spark, skewed, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{skewed}/{t}.parquet'")
    sdf = E.queries()[name](spark, skewed)
    cols = sorted(sdf.columns)
    norm = lambda r: tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r)
    got = sorted((norm(tuple(r[c] for c in cols)) for r in sdf.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((norm(tuple(r[i] for i in idx)) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want
