"""A corpus that grows by segments equals one that is rebuilt."""

import os
import tempfile

import pytest

from conftest import SF_SMALL
from sifter.plans import segments as G
from sifter.plans.analysis import compare_corpus, derive_corpus


def parts(prepared):
    return {name: sorted(map(repr, getattr(prepared, name).select(sorted(getattr(prepared, name).columns)).collect())) for name in G.PARTS}


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60").select("doc_id", "text", "source")


def same(spark, path, expected, params):
    return parts(G.read_segments(spark, path, "doc_id")) == parts(derive_corpus(expected, "doc_id", params))


def test_add_delete_replace_compact_equal_a_rebuild(spark, docs, params):
    path = tempfile.mkdtemp(prefix="sifter-seg-") + "/corpus"
    new = docs.where("doc_id between 30 and 44").selectExpr("doc_id", "upper(text) as text", "source")
    G.add(docs.where("doc_id < 40"), "doc_id", params, path)
    G.add(new, "doc_id", params, path)  # replaces 30 to 39, adds 40 to 44
    G.delete(spark.createDataFrame([(3,), (41,), (999,), (None,)], "doc_id bigint"), "doc_id", path)
    G.add(docs.where("doc_id = 3"), "doc_id", params, path)  # back again
    want = docs.where("doc_id < 30").unionByName(new.where("doc_id <> 41"))
    assert same(spark, path, want, params)
    before = G.read_manifest(path)
    assert [s.rows for s in before.segments] == [40, 15, 1] and [t.rows for t in before.tombstones] == [10, 2]
    after = G.compact(spark, path, "doc_id", ratio=20)  # 1 and 15 merge, then 40
    assert len(after.segments) == 1 and after.tombstones == [] and after.segments[0].rows == 44
    assert same(spark, path, want, params)
    # earlier versions stay readable until vacuum
    first = parts(G.read_segments(spark, path, "doc_id", version=1))
    assert first == parts(derive_corpus(docs.where("doc_id < 40"), "doc_id", params))
    assert len(G.vacuum(path)) == 6  # three segments, three tombstone tables (the last add's is empty)
    assert G.versions(path) == [after.version]
    assert same(spark, path, want, params)


def test_partial_compaction_keeps_what_older_segments_need(spark, docs, params):
    path = tempfile.mkdtemp(prefix="sifter-seg-") + "/corpus"
    G.add(docs.where("doc_id < 40"), "doc_id", params, path)
    G.add(docs.where("doc_id between 40 and 45"), "doc_id", params, path)
    G.add(docs.where("doc_id between 46 and 52"), "doc_id", params, path)
    G.delete(docs.where("doc_id in (5, 42)").select("doc_id"), "doc_id", path)
    m = G.compact(spark, path, "doc_id")
    assert [s.rows for s in m.segments] == [40, 12] and len(m.tombstones) == 1
    assert same(spark, path, docs.where("doc_id < 53 and doc_id not in (5, 42)"), params)
    assert G.compact(spark, path, "doc_id") == m  # nothing left to do


def test_ranking_over_segments(spark, docs, params):
    path = tempfile.mkdtemp(prefix="sifter-seg-") + "/corpus"
    for low, high in ((0, 20), (20, 45), (45, 60)):
        G.add(docs.where(f"doc_id >= {low} and doc_id < {high}"), "doc_id", params, path)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    rank = lambda corpus: sorted(map(repr, compare_corpus(
        bench, corpus, "item_id", "doc_id", params, top_n=4, corpus_cols=("source",)).collect()))
    assert rank(G.read_segments(spark, path, "doc_id")) == rank(docs)


def test_odd_input(spark, params):
    path = tempfile.mkdtemp(prefix="sifter-seg-") + "/corpus"
    with pytest.raises(FileNotFoundError):
        G.read_segments(spark, path, "doc_id")
    rows = [(1, None, 1), (2, "", 2), (None, "no id", 3), (3, "one two three.", 4), (3, "one two three.", 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, tf int")
    G.add(df.limit(0), "doc_id", params, path)
    G.delete(df.select("doc_id"), "doc_id", path)
    G.add(df, "doc_id", params, path)
    G.add(spark.createDataFrame([(2, "now a text", "x")], "doc_id bigint, text string, extra string"), "doc_id", params, path)
    got = G.read_segments(spark, path, "doc_id").rows.collect()
    assert sorted((r.doc_id, r.tf, r.extra) for r in got if r.doc_id != 3 and r.doc_id != 2) == [(1, 1, None)]
    assert [(r.tf, r.extra) for r in got if r.doc_id == 2] == [(None, "x")]
    assert len([r for r in got if r.doc_id == 3]) == 2


def test_what_a_failed_add_left_is_in_no_version(spark, docs, params):
    path = tempfile.mkdtemp(prefix="sifter-seg-") + "/corpus"
    m = G.add(docs.where("doc_id < 5"), "doc_id", params, path)
    os.makedirs(f"{path}/segments/half-written/terms")
    assert same(spark, path, docs.where("doc_id < 5"), params)
    with pytest.raises(RuntimeError):  # a second writer of the same version
        G._publish(path, m)
    assert G.vacuum(path) == ["segments/half-written"]
