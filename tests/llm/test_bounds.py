import glob

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sifter.llm import common, langid, pieces, token_files
from tests.llm import brute

SF_MID = "/root/testdata/sf0.01"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
RUSSIAN = "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Все смешалось в доме. "
POLISH = "Litwo! Ojczyzno moja! ty jesteś jak zdrowie; Ile cię trzeba cenić, ten tylko się dowie, Kto cię stracił. Dziś piękność twą widzę. "


def test_foreign_and_random_texts_are_rejected_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang", "source")
    rng = np.random.default_rng(1)
    letters = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz   "), n)) for n in (400, 3000)]
    bad = [(-k - 1, t, "en", "src1") for k, t in enumerate([*letters, RUSSIAN * 5, POLISH * 5, "12345 !!", "", None])]
    rows = docs.unionByName(spark.createDataFrame(bad, docs.schema))
    got = langid.identify(rows, langid.train(docs, "text", "lang"), "text", declared="lang", host="source")
    ok = {r[0]: r[1] for r in got.select("doc_id", "lang_ok").collect()}
    assert not any(ok[-k - 1] for k in range(len(bad)))
    assert sum(v for k, v in ok.items() if k >= 0) >= 0.98 * docs.count()


def test_hundreds_of_labels(spark):
    rng = np.random.default_rng(2)
    words = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)) for _ in range(230)]
    rows = [(k, words[k % 230] * 3, f"l{k % 230}", "h") for k in range(460)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    languages, table = langid.train(df, "text", "lang")
    assert len(languages) == 230 and table.shape[1] == 230
    got = langid.identify(df, (languages, table), "text", declared="lang", host="source")
    assert got.where("lang_id = lang").count() >= 0.95 * len(rows)


def test_token_files_have_the_stated_layout(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    token_files.write_tokens(docs, str(tmp_path / "tokens"), BYTE)
    for path in glob.glob(str(tmp_path / "tokens" / "*.parquet")):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(k).path_in_schema: meta.row_group(g).column(k) for k in range(meta.num_columns)}
            ids = next(c for n, c in columns.items() if n.startswith("ids"))
            assert "RLE_DICTIONARY" in ids.encodings and "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
            assert all(c.has_column_index and c.has_offset_index for c in columns.values())
            assert meta.row_group(g).total_byte_size <= 1.5 * token_files.ROW_GROUP_BYTES


def test_whole_texts_are_not_remembered():
    encoder = token_files.PieceEncoder(Tokenizer.from_file(BYTE))
    encoder.encode(pa.array(["a plain text of words"] + [f"un texte {k}\xa0: entier " + "long " * 50 for k in range(300)] + [None]))
    assert all(len(p) <= pieces.PIECE_BYTES for p in encoder.codes) and len(encoder.codes) < 20 and encoder.used < 100
    few = pieces.PieceMemo.__new__(token_files.PieceEncoder)
    few.__init__(Tokenizer.from_file(BYTE))
    few.most = 5
    texts = ["one two three four five six seven eight", "six seven eight nine one"] * 3
    for _ in range(2):
        ids, ends = few.encode(pa.array(texts))
        assert [ids[s:e].tolist() for s, e in zip(ends, ends[1:])] == [few.tokenizer.encode(t).ids for t in texts] and len(few.codes) <= 5


def test_a_worker_holds_one_object():
    common.release()
    assert common.held(("a",), lambda: 1) == 1 and common.held(("a",), lambda: 2) == 1
    assert common.held(("b",), lambda: 3) == 3 and list(common._HELD) == [("b",)]
    common.release()


def test_hot_keys_join_like_all_others(spark):
    rows = spark.createDataFrame([(0 if k % 2 else k, k) for k in range(20000)], "key long, x long")
    table = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    got = common.hot_join(rows, table, "key", "n")
    assert got.columns == ["key", "x", "n"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(table, "key").collect()))


def test_near_copies_of_a_third_of_all_documents(spark):
    import hashlib
    import random

    from sifter.llm import suffix_dedup

    r = random.Random(4)

    def prose(n):
        return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(n))

    base, rows = prose(120), []
    for k in range(300):
        copy = list(base)
        for _ in range(2):
            copy[r.randrange(len(copy))] = "Z"
        rows.append((k, prose(40) + ("".join(copy) if k % 3 == 0 else "")))
    rows += [(5000, base), (5000, base), (None, base), (5001, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffix_dedup.repeated_bytes(df, split=20, shard_bytes=1 << 14).collect()
    found = sorted((str(x.doc_id), sum(s.stop - s.start for s in x.spans), len(x.spans), hashlib.sha256(bytes(x.kept)).hexdigest()) for x in got)
    assert found == sorted((str(i), x[1], x[2], x[3]) for (i, _), x in zip(rows, brute.repeated_bytes([t for _, t in rows])))
