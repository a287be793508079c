import corpus_pipeline
import numpy as np
import public_tokenizers
from tests.llm import brute
from tokenizers import Tokenizer

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        kept[name] = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    first, dedup, clean, redacted = kept.values()
    assert len(first) >= 195
    classes = brute.near_classes(list(first.items()))
    assert set(dedup) == {c for _, c in classes.values()}
    items = [r[0].split() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("text").collect()]
    assert set(clean) <= set(dedup) and not [1 for t in clean.values() for i in items if " ".join(i) in " ".join(t.split())]
    assert set(redacted) == set(clean) and not any(brute.base_spans(t) for t in redacted.values())
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(out) == set(redacted)
    for i, text in list(redacted.items())[:50]:
        ids = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(bytes(out[i].ids), "<u4").tolist() == ids and out[i].decoded == tok.decode(ids, skip_special_tokens=False)


def test_stages_survive_odd_rows_and_empty_tables(spark):
    for docs in (brute.odd_documents(spark).select("doc_id", "text", "lang", "source", "fp").withColumnRenamed("fp", "n_chars"),
                 spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            assert name == "BPE encoding and decoding" or docs.columns == columns
        docs.collect()
