import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sifter.llm import (bpe_lexicon, decontaminate, knn_join, langid, lexicon, pii, quality, ring, simhash, suffix_array,
                        suffix_dedup, token_files)
from sifter.llm.components import components
from sifter.llm.queries import QUERIES
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def odd(spark):
    return brute.odd_documents(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r[0], r[1]) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]


def pairs(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- BPE -------------------------------------------------------------------------------

def test_bpe_equals_the_library(odd, docs, rows):
    tok = Tokenizer.from_file(WORD)
    for df, texts in ((odd, [(r[0], r[1]) for r in odd.select("doc_id", "text").collect()]), (docs, rows)):
        got = bpe_lexicon.encode(df, WORD, ["doc_id"], decode=True, most=500).collect()
        want = []
        for i, t in texts:
            ids = tok.encode(t or "", add_special_tokens=False).ids
            want.append((i, np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False)))
        assert sorted((r[0], bytes(r[1]), r[2]) for r in got if r[0] is not None) == sorted(w for w in want if w[0] is not None)
        assert len(got) == len(want)
    assert bpe_lexicon.encode(docs.limit(0), WORD, ["doc_id"]).count() == 0


def test_lexicon_shares_suffixes_and_finds_exactly(tmp_path):
    words = sorted({a + b for a in (b"", b"walk", b"talk", b"bal\xc3") for b in (b"ing", b"ed", b"s", b"")})
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.compile_words(words, [[len(w), 7] for w in words]))
    lex = lexicon.Lexicon(str(path))
    assert lex.numbers([*words, b"walkin", b"x", b"walkings" * 9]).tolist() == [*range(len(words)), -1, -1, -1]
    assert [lex.output(k) for k in range(len(words))] == [[len(w), 7] for w in words]
    assert len(lex.final) < sum(map(len, words)) / 2
    path.write_bytes(lexicon.compile_words([], []))
    assert lexicon.Lexicon(str(path)).numbers([b"a", b""]).tolist() == [-1, -1]


def test_long_words_merge_like_short_ones():
    bpe = bpe_lexicon.WordBpe(WORD)
    tok = Tokenizer.from_file(WORD)
    for word in ("a" * 300, "thelongesttokens" * 20, "!?" * 100):
        assert bpe.merge(word.encode()) == tok.encode(word, add_special_tokens=False).ids


# -- kNN -------------------------------------------------------------------------------

def neighbours(items, every, k):
    out = []
    for q, v in items:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in items if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("pivots", [1, 7])
def test_knn_equals_brute_force(spark, pivots):
    rng = np.random.default_rng(pivots)
    vectors = [[float(x) for x in rng.normal(0, 0.2, 6)] for _ in range(300)] + [[0.5] * 6] * 60
    order = rng.permutation(len(vectors))
    df = spark.createDataFrame([(int(i), vectors[i]) for i in order] + [(900, None), (901, [None] + [0.0] * 5), (902, [float("nan")] * 6),
                               (903, [float("inf")] * 6), (None, [0.0] * 6)], "vec_id long, embedding array<double>")
    items = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in enumerate(vectors)]
    got = knn_join.knn_join(df, every=10, pivots=pivots).select("query_id", "rank", "vec_id", "score")
    assert pairs(got) == sorted(neighbours(items, 10, 5), key=repr)


def test_knn_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert knn_join.knn_join(spark.createDataFrame([], schema)).count() == 0
    assert knn_join.knn_join(spark.createDataFrame([(50, [1.0])], schema)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5]), (1, [0.5]), (2, [0.5, 0.0])], schema)
    assert pairs(knn_join.knn_join(few).select("query_id", "rank", "vec_id", "score")) == [(0, 1, 1, 256 * 128), (0, 2, 2, 256 * 128)]


def test_rings_out_of_reach_are_left_out():
    points = np.array([[100.0, 0.0], [-100.0, 0.0]])
    rings = [(0, 0, 9, 0.0, 5.0, 9000.0, 11000.0), (1, 0, 9, 0.0, 5.0, 9000.0, 11000.0)]
    assert knn_join.needed_rings(points, [(0, 5.0, 9000.0, 11000.0)], rings, 6) == [(0, 0, 0)]


# -- suffix arrays -----------------------------------------------------------------------

def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(5)
    for alphabet in (2, 3, 250):
        texts = [bytes(rng.integers(0, alphabet, rng.integers(0, 40)).tolist()) for _ in range(6)]
        texts += texts[:2]
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(texts)), sizes)
        ends = (starts + sizes)[owner]
        keys = suffix_array.packed(data, ends)
        order, rank = suffix_array.suffix_array(keys, ends, owner)
        suffix = [data[i: ends[i]].tobytes() for i in range(len(data))]
        assert order.tolist() == sorted(range(len(data)), key=lambda i: ([b + 1 for b in suffix[i]] + [0], owner[i]))
        prefix = suffix_array.common_prefixes(keys, order, rank, starts[sizes > 0], ends)
        for k in range(1, len(order)):
            a, b = suffix[order[k - 1]], suffix[order[k]]
            assert prefix[k] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("split", [2, 8192])
def test_repeated_bytes_equal_brute_force(docs, rows, odd, split):
    for df, texts in ((docs, rows), (odd, [(r[0], r[1]) for r in odd.select("doc_id", "text").collect()])):
        got = suffix_dedup.repeated_bytes(df, split=split, shard_bytes=1 << 16).collect()
        found = sorted(((r[0], len(r[2]) + sum(s[1] - s[0] for s in r[1]), sum(s[1] - s[0] for s in r[1]), len(r[1]), hashlib.sha256(bytes(r[2])).hexdigest()) for r in got), key=repr)
        assert found == sorted(((i, *x) for (i, _), x in zip(texts, brute.repeated_bytes([t for _, t in texts]))), key=repr)


def test_repeats_in_an_empty_table(docs):
    assert suffix_dedup.repeated_bytes(docs.limit(0)).count() == 0


# -- quality -----------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op4_subword_quality"](spark, sf)
    assert got.count() == 1000
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].score.mean() > 0.9 > 0.5 > held[held.quality == 0].score.mean()
    assert got.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1) != F.col("held_out")).count() == 0


def test_quality_sample_of_very_many_labels(spark):
    ids = spark.range(20_000_000)
    for total, want in ((2 * 10**9, 30), (10**10, 6)):
        assert want / 3 < ids.where(quality.sampled("id", 3000, total)).count() < want * 2


def test_quality_of_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 0), (4, None), (None, 1), (6, 1), (99, 0)], "doc_id long, quality int")
    got = quality.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert quality.classify(docs.limit(0), labels).count() == 0
    none = quality.classify(odd, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


# -- decontamination ---------------------------------------------------------------------

def test_contained_items_of_odd_rows(spark, odd):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    df = odd.select("doc_id", "text").union(spark.createDataFrame(
        [(100, "noise " * 5000 + text.upper().replace(" ", ", ") + " noise"), (101, text.replace("mu", "nu")), (102, text[:40])], "doc_id long, text string"))
    items = spark.createDataFrame([(1, text), (1, text), (2, "one two"), (3, None), (None, text), (4, ""), (5, "alpha beta gamma delta epsilon")], "item_id long, text string")
    got = {(r[0], r[1]): r[4] for r in decontaminate.contained_items(df, items).collect()}
    assert got == {(100, 1): 1.0, (100, 5): 1.0, (101, 1): 0.875, (101, 5): 1.0, (102, 5): 1.0}
    assert sorted(r[0] for r in decontaminate.without_items(df, items).select("doc_id").collect() if r[0] is not None and r[0] >= 100) == []
    assert decontaminate.without_items(odd, items).count() == odd.count()
    assert decontaminate.contained_items(df, items.limit(0)).count() == 0 and decontaminate.contained_items(df.limit(0), items).count() == 0


def test_item_blocks_give_the_same(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = pairs(decontaminate.contained_items(docs, items))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 15)
    assert pairs(decontaminate.contained_items(docs, items)) == want and want


def test_sketches_miss_nothing():
    for n in range(1, 300):
        for missing in range(n + 1):
            if n - missing >= 0.8 * n:
                assert decontaminate.sketch_size(n) > missing


# -- language ----------------------------------------------------------------------------

def test_language_on_unseen_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.where("doc_id % 2 = 0"), "text", "lang")
    got = langid.identify(docs.where("doc_id % 2 = 1"), model, "text", host="source")
    assert got.where("lang_ok and lang_id = lang").count() >= 0.98 * got.count()


def test_language_evidence_decides_short_texts(spark, odd, docs):
    model = langid.train(docs, "text", "lang")
    rows = [(k, "de", f"www.site{k % 3}.de", "xx") for k in range(40)] + [(100, "", "www.site0.de", "xx"), (101, "ok", None, None), (102, None, "", "yy")]
    df = spark.createDataFrame(rows, "id long, text string, host string, suffix string")
    got = {r.id: r for r in langid.identify(df, model, "text", host="host", suffix="suffix").collect()}
    assert got[0].lang_ok and not got[100].lang_ok and not got[102].lang_ok and len(got) == len(rows)
    assert langid.identify(odd, model, "text", "lang", host="source").count() == odd.count()
    assert langid.identify(odd.limit(0), model, "text").count() == 0
    assert langid.identify(odd, langid.train(docs.limit(0), "text", "lang"), "text").where("lang_ok").count() == 0


def test_pages_give_their_evidence(spark):
    pages = spark.createDataFrame([(1, "https://a.Example.co.uk:80/x", '<html class="x" lang="EN-gb"><script>var t="</p>";</script><p>Text &amp; more</p>'),
                                   (2, None, None), (3, "nonsense", "<p")], "page_id long, url string, html string")
    got = {r.page_id: r for r in langid.from_page(pages).collect()}
    assert (got[1].host, got[1].suffix, got[1].declared, got[1].text.split()) == ("a.example.co.uk", "uk", "en", ["Text", "&amp;", "more"])
    assert (got[2].host, got[2].suffix, got[2].declared, got[2].text) == (None, None, None, None) and got[3].host is None


# -- personal data -----------------------------------------------------------------------

def test_base_spans_equal_python(docs, rows, odd):
    for df, texts in ((docs, rows), (odd, [(r[0], r[1]) for r in odd.select("doc_id", "text").collect()])):
        got = sorted(((r[0], [tuple(s) for s in r[1]]) for r in pii.annotate(df).select("doc_id", "pii_base").collect()), key=repr)
        assert got == sorted(((i, brute.base_spans(t)) for i, t in texts), key=repr)


def test_long_lists_of_spans(spark):
    text = "🙂 a@b.c 1.2.3.4 " * 700
    got = pii.annotate(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().pii_base
    assert [tuple(s) for s in got] == brute.base_spans(text)


def test_labelers_add_what_the_rules_miss(spark):
    rows = [(k, f"word {k} call +1 (212) 555-{k:04d} now") for k in range(60)] + [(k, f"serial {10**9 + k * 7919}x{k} end") for k in range(100, 160)]
    rows += [(200, "phone (212) 555-0199 please"), (201, "from 2019-04-05 on")]
    found = pii.annotate(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r[0]: [tuple(s) for s in r[1]] for r in pii.decide(found, pii.fit(found)).select("doc_id", "pii_spans").collect()}
    assert all(got[k] and got[k][0][0] == "phone" for k in range(60)) and not any(got[k] for k in range(100, 160))
    assert got[200] == [("number", 6, 20)] and got[201] == []


def test_numbers_side_by_side(spark):
    cards, solid = ["4111 1111 1111 1111", "5500 0000 0000 0004"], ["4111111111111111", "5500000000000004"]
    phones = ["(212) 555-0199", "(212) 555-0100", "(646) 555-0123"]
    lists = {-1: cards, -2: solid, -3: phones, -4: solid * 3, -5: [phones[0], *cards], -6: phones * 50, -7: ["212 555 0199", "212 555 0100", "646 555 0123"]}
    texts = {k: f"my {' '.join(x)} end" for k, x in lists.items()}
    texts |= {-8: "at +1 (826) 555-4081 190.137.223.204 end", -9: "🙂 190.137.223.204 (826) 555-4081", -10: "no " + "7" * 3000 + " 1 2 3 4 5 6 7 8 9" * 200}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").union(rows)
    found = pii.annotate(df)
    got = {r[0]: [(s.kind, texts[r[0]][s.start: s.stop]) for s in r[1]] for r in pii.decide(found, pii.fit(found)).select("doc_id", "pii_spans").where("doc_id < 0").collect()}
    for k, x in lists.items():
        assert got[k] == [("number", n) for n in x]
    assert got[-8] == [("ip", "190.137.223.204"), ("number", "1 (826) 555-4081")] and got[-9] == [("ip", "190.137.223.204"), ("number", "(826) 555-4081")]
    assert got[-10] == []
    clean = dict(pii.redact(df).where("doc_id < 0").collect())
    assert clean[-2] == "my [NUMBER] [NUMBER] end" and clean[-8] == "at +[NUMBER] [IP] end"
    # also where no run is a candidate by itself
    only = spark.createDataFrame([(k, f"({200 + k}) 555-{k:04d} ({300 + k}) 555-{7 * k:04d}") for k in range(50)], "doc_id long, text string")
    assert {r[1] for r in pii.redact(only).collect()} == {"[NUMBER] [NUMBER]"}


def test_redaction(spark, odd):
    df = spark.createDataFrame([(1, "I am a@b.com at 1.2.3.4, +1 (377) 555-0271", 9), (2, "clean", 8), (3, None, 7)], "doc_id long, text string, n long")
    assert pairs(pii.redact(df)) == [(1, "I am [EMAIL] at [IP], [PHONE]", 9), (2, "clean", 8), (3, None, 7)]
    assert pii.redact(odd).columns == odd.columns and pii.redact(odd).count() == odd.count() and pii.redact(odd.limit(0)).count() == 0


def test_personal_data_stays_in_the_jvm(docs):
    plan = pii.redact(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# -- token files -------------------------------------------------------------------------

def test_token_files(spark, docs, rows, odd, tmp_path):
    tok = Tokenizer.from_file(BYTE)
    start, want = 0, []
    for i, t in rows:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, BYTE)
    assert sorted(map(tuple, token_files.token_digests(spark, path).collect())) == want
    assert [r[0] for r in token_files.read_tokens(spark, path, 10, 13).orderBy("doc_id").select("doc_id").collect()] == [10, 11, 12]
    got = token_files.store(odd, BYTE).orderBy("start").collect()
    texts = odd.select("doc_id", "text").collect()
    sizes = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
    assert sorted(r.n_tokens for r in got) == sizes and [r.doc_id for r in got][:2] == [None, None]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    assert token_files.store(odd.limit(0), BYTE).count() == 0


# -- near-duplicates -----------------------------------------------------------------------

def test_near_duplicates_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute.near_classes([(r[0], r[1]) for r in df.select("doc_id", "text").collect()])
    for tile in (3, 4096):
        got = {r[0]: (r[1], r[2]) for r in simhash.near_duplicates(df, tile=tile).collect()}
        assert got == want
    kept = simhash.keep_one(df)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted({c for _, c in want.values()}) and kept.columns == df.columns


def test_near_duplicates_of_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    words = {r.doc_id: r for r in got}
    assert words[0].fingerprint == "0" * 16 and words[0].component_id == words[1].component_id == words[2].component_id == 0
    assert words[16].component_id == 4
    kept = simhash.keep_one(odd)
    ids = [r[0] for r in kept.select("doc_id").collect()]
    classes = simhash.simhash_classes(odd, ["doc_id"]).select("root").distinct().count()
    assert len(ids) == classes and kept.columns == odd.columns and None not in ids and ids.count(3) == 2  # one id, two texts
    assert simhash.near_duplicates(odd.limit(0)).count() == 0 and simhash.keep_one(odd.limit(0)).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(200, 200), (None, 1), (300, 299), (299, 300)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 180)} | {299: 299, 300: 299}


# -- sharding ----------------------------------------------------------------------------

def test_shards_are_level_and_slots_gapless(docs, odd):
    for df in (docs, odd):
        got = ring.shard_rows(df).toPandas()
        assert len(got) == df.count()
        counts = got.groupby("shard").size().reindex(range(24), fill_value=0)
        assert counts.max() - counts.min() <= 1
        assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard").slot)
    sizes = {(r[0], r[1]): (r[2], r[3]) for r in ring.shard_rows(odd).join(odd.withColumnsRenamed({"doc_id": "d"}), F.lit(False)).selectExpr("doc_id", "text", "size", "text_crc32").collect()}
    assert sizes == {} and ring.shard_rows(odd.limit(0)).count() == 0
    row = ring.shard_rows(odd).where("doc_id = 11").first()
    assert (row.size, row.text_crc32) == (len(brute.ODD[11].encode()) + 8, zlib.crc32(brute.ODD[11].encode()))


def test_a_hot_key_is_ranked_in_parts(spark):
    df = spark.createDataFrame([(7 if k % 3 else k, f"t{k % 5}") for k in range(3000)], "doc_id long, text string")
    got = ring.shard_rows(df, group_rows=100).toPandas()
    assert got.groupby("shard").size().tolist() == [125] * 24 and all(sorted(s) == list(range(125)) for _, s in got.groupby("shard").slot)


def test_slack_limits_movement(spark):
    df = spark.range(20000).selectExpr("id as doc_id", "'x' as text")
    one, two = (ring.shard_rows(df, shards=n, slack=0.25).select("doc_id", "shard").toPandas().set_index("doc_id").shard for n in (24, 25))
    assert one.value_counts().max() <= 1.25 * 20000 / 24 + 1
    assert (one != two.reindex(one.index)).mean() < 0.12
