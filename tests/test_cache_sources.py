import io
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from sifter.operators import cache as K
from sifter.sources import corpus as S


def test_cache_second_run_has_no_misses(spark, params):
    path = tempfile.mkdtemp(prefix="sifter-cache-") + "/cache"
    df = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "alpha beta")], "id bigint, text string")
    first = {r.id: r.emb for r in K.embed_with_cache(df, params, path).collect()}
    model = K.model_id(params)
    keyed = K.content_keys(df, model)
    _, misses = K.split_hits(keyed, K.read_cache(spark, path, model))
    assert misses.count() == 0
    assert K.read_cache(spark, path, model).count() == 2  # duplicate text encoded once
    second = {r.id: r.emb for r in K.embed_with_cache(df, params, path).collect()}
    assert first == second and first[1] == first[3]
    assert K.read_cache(spark, path, model).count() == 2


def _docx(paragraphs):
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    xml = f'<?xml version="1.0"?><w:document xmlns:w="{ns}"><w:body>{body}</w:body></w:document>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", xml)
    return buf.getvalue()


def test_load_corpus(spark):
    d = tempfile.mkdtemp(prefix="sifter-corpus-")
    files = {
        "a.txt": b"  from txt  \n",
        "a.docx": _docx(["first para", "   ", "second para"]),
        "b.txt": b"   ",
        "c.TXT": b"upper case suffix",
        "d.txt": b"bad \xff\xfe bytes",
        "e.bin": b"ignored",
        "f.pdf": b"%PDF-1.4 not parsed without an extractor",
    }
    for name, data in files.items():
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(data)
    corpus, quarantine = S.load_corpus(spark, d)
    got = {r.name: r.text for r in corpus.collect()}
    # a.txt sorts after a.docx, so the .txt text wins the stem "a"; b.txt is empty
    assert got == {"a": "from txt", "c": "upper case suffix", "d": "bad  bytes"}
    q = {r.name: r.error for r in quarantine.collect()}
    assert set(q) == {"f"}
    assert S.docx_text(files["a.docx"]) == "first para\nsecond para"
    with_pdf, _ = S.load_corpus(spark, d, pdf_extractor=lambda b: b.decode()[9:])
    assert {r.name for r in with_pdf.collect()} == {"a", "c", "d", "f"}
    counts = {r.suffix: r.n_docs for r in S.corpus_counts(corpus).collect()}
    assert counts == {".txt": 3}


def test_corpus_mode_through_cache(spark, params):
    from conftest import SF_SMALL
    from sifter.plans.analysis import compare_corpus

    path = tempfile.mkdtemp(prefix="sifter-cache-") + "/cache"
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    plain = compare_corpus(bench, docs, "item_id", "doc_id", params, top_n=5)
    cached = compare_corpus(bench, docs, "item_id", "doc_id", params, top_n=5, cache_path=path)
    cols = sorted(plain.columns)
    assert sorted(plain.select(cols).collect()) == sorted(cached.select(cols).collect())
    n = K.read_cache(spark, path, K.model_id(params)).count()
    again = compare_corpus(bench, docs, "item_id", "doc_id", params, top_n=5, cache_path=path)
    assert sorted(again.select(cols).collect()) == sorted(plain.select(cols).collect())
    assert K.read_cache(spark, path, K.model_id(params)).count() == n  # warm run adds nothing


def test_write_results(spark):
    from sifter.sources.sinks import write_results
    out = tempfile.mkdtemp(prefix="sifter-out-") + "/res"
    df = spark.createDataFrame([(1, 0.5), (2, 0.7)], "q bigint, s double")
    write_results(df, out, partition_by=["q"])
    assert sorted(spark.read.parquet(out).select("q", "s").collect()) == sorted(df.collect())
