"""Large keys, NULLs, plan shape and loader cases."""

import io
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sifter import catalog, session
from sifter.catalog import QUERIES
from sifter.catalog_sql import oracle_sql
from sifter.operators import chunking as C
from sifter.operators import embedding as E
from sifter.operators import scoring as S
from sifter.operators import vectors as V
from sifter.operators.common import by_key
from sifter.sources import corpus as L


def test_large_document_and_chunk_ids_survive(spark, params):
    big, many = (1 << 43) + 5, (1 << 20) + 3
    q = spark.createDataFrame([(7, 0, [1.0, 0.0]), (1 << 50, many, [0.0, 1.0])], "item_id long, chunk_no int, emb array<float>")
    d = spark.createDataFrame([(big, many, [1.0, 0.0]), (big + 1, 0, [0.0, 1.0]), (9, 1, None)], "doc_id long, chunk_no int, emb array<float>")
    got = {(r.item_id, r.doc_id): r.n_hits for r in S.chunk_hits(q, d, "item_id", "doc_id", params).collect()}
    assert got == {(i, j): 1 for i in (7, 1 << 50) for j in (big, big + 1)}
    pairs = spark.createDataFrame([(7, big)], "a_id long, b_id long")
    f = S.similar_fragments(pairs, q.withColumnRenamed("item_id", "a_id"), d.withColumnRenamed("doc_id", "b_id"), params).collect()
    assert [(r.a_chunk, r.b_chunk) for r in f] == [(0, many)]


def test_late_turns_keep_their_conversation(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    rows = [(1 << 47, 65536, "user", "the one the two"), (3, 70000, "user", "one"), (4, 1, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.turn): r.perplexity for r in QUERIES["perplexity"](spark, str(tmp_path)).collect()}
    assert set(got) == {(1 << 47, 65536), (3, 70000), (4, 1)} and got[(1 << 47, 65536)] > 0 and got[(4, 1)] is None



@pytest.fixture(scope="module")
def with_nulls(spark, tmp_path_factory):
    """The small tables, each with rows of NULL payload, under new ids."""
    out = tmp_path_factory.mktemp("nulls")
    payload = {"documents": "text", "benchmark": "text", "conversations": "text", "embeddings": "embedding", "labels": None, "pages": None}
    for t, c in payload.items():
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if c:
            key = df.columns[0]
            df = df.union(df.limit(3).withColumn(c, F.lit(None).cast(df.schema[c].dataType)).withColumn(key, F.col(key) + 1_000_000))
        df.write.parquet(f"{out}/{t}.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["chunk_documents", "hash_embedding", "corpus_top10", "analyze_pairs", "vector_topk", "mean_pool", "ai_probability",
                                  "tokenize", "split_sentences", "minhash_signature", "cache_misses"])
def test_null_rows_change_nothing_else(spark, with_nulls, name):
    clean = QUERIES[name](spark, SF_SMALL)
    keys = [c for c in ("doc_id", "item_id", "conv_id", "vec_id", "q_vec_id") if c in clean.columns]
    got = QUERIES[name](spark, with_nulls)
    for k in keys:
        got = got.where(F.col(k) < 1_000_000)
    cols = sorted(clean.columns)
    assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, clean.select(cols).collect()))


def test_null_text_and_vectors(spark, params):
    df = spark.createDataFrame([(1, "One two. Three."), (2, None), (3, "")], "id long, text string")
    assert sorted(r[0] for r in C.chunk_documents(df, "id", params).select("id").collect()) == [1, 3]
    assert {r.id: r.emb is None for r in E.embed(df, params).collect()} == {1: False, 2: True, 3: False}
    own = E.embed(df, params, encoder=lambda texts: [[1.0, len(t)] for t in texts])
    assert {r.id: r.emb is None for r in own.collect()} == {1: False, 2: True, 3: False}
    v = spark.createDataFrame([(1, [1.0]), (2, None)], "v long, emb array<float>")
    assert V.topk_similar(v.withColumnRenamed("v", "q"), v, "q", "v", 3, params).count() == 1


@pytest.mark.parametrize("name", ["normalize_text", "tokenize", "preprocess_tokens", "preprocess_text", "split_sentences", "sentence_lengths",
                                  "content_keys", "chunk_documents"])
def test_map_only_queries_have_no_exchange(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_partitioning_by_key_runs_no_job(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("by-key", "no job expected")
    by_key(by_key(docs, "doc_id", "text"), "doc_id", "text")
    assert list(tracker.getJobIdsForGroup("by-key")) == []
    spark.sparkContext.setJobGroup("", "")


def test_docx_keeps_breaks_and_leaves_tables_out():
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = ("<w:p><w:r><w:t>one</w:t><w:tab/><w:t>two</w:t><w:br/><w:t>three</w:t></w:r></w:p>"
            "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:r><w:t>last</w:t></w:r></w:p>")
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{body}</w:body></w:document>")
    assert L.docx_text(data.getvalue()) == "one\ttwo\nthree\nlast"


def test_document_ids_are_dense_and_repeatable(spark):
    names = spark.createDataFrame([(f"n{k:03d}",) for k in range(200)], "name string").repartition(7)
    got = {r.name: r.doc_id for r in L.with_doc_ids(names).collect()}
    assert got == {f"n{k:03d}": k for k in range(200)}


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return None

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_pair_list_is_a_threshold(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.sql(f"SELECT item_id, doc_id FROM ({oracle_sql()['tfidf_pair_similarity']}) WHERE lex >= {catalog.PAIR_MIN_LEX} "
                   f"UNION SELECT item_id, doc_id FROM ({oracle_sql()['passage_runs']})").fetchall()
    assert sorted(map(tuple, catalog._pairs(spark, SF_SMALL).collect())) == sorted(want) and want


def test_prepared_corpus_is_scored_without_texts(spark, tmp_path):
    from sifter.params import DEFAULT
    from sifter.plans import analysis as A

    A.write_corpus(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id", DEFAULT, str(tmp_path / "corpus"))
    ready = A.read_corpus(spark, str(tmp_path / "corpus"))
    queries = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = A.compare_corpus(queries, ready, "item_id", "doc_id", DEFAULT, top_n=3, corpus_cols=("source",))
    assert "documents.parquet" not in got._jdf.queryExecution().toString() and got.count() == 120


def test_broadcasts_are_bounded_by_bytes(spark):
    from sifter.operators.common import bounded_broadcast

    df = spark.createDataFrame([("x" * 100,)] * 50, "t string")
    assert bounded_broadcast(df, 1000)[1] and not bounded_broadcast(df, 1000, 3000)[1] and not bounded_broadcast(df, 10)[1]
