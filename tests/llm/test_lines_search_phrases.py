import random

import numpy as np
import pytest

from sifter.llm import bits, lexical_search, line_dedup, phrases, quotient
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    return brute.odd_documents(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def same(a, b):
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)


# -- lines -----------------------------------------------------------------------------

def test_filter_has_no_false_negatives_and_merges_segments():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    data = np.zeros(1 << 18, np.uint8)
    for at in bits.places(hashes, 21):
        bits.set_bits(data, at)
    one, two = bits.places(hashes, 21)
    assert bits.get_bits(data, one).all() and bits.get_bits(data, two).all()
    one, two = bits.places(rng.integers(0, 1 << 64, 5000, dtype=np.uint64), 21)
    assert (bits.get_bits(data, one) & bits.get_bits(data, two)).mean() < 0.001
    parts = dict(bits.set_places(data))
    for segment, at in parts.items():
        flags = np.unpackbits(data[segment << 17: (segment + 1) << 17], bitorder="little").view(bool)
        assert (bits.unpack_segment(bits.pack_segment(at)) == flags).all()
    full = np.arange(0, 1 << 20, 3)
    assert (np.flatnonzero(bits.unpack_segment(bits.pack_segment(full))) == full).all()


def line_rows():
    rng = random.Random(3)
    common = "  Shared LINE of many documents\t"
    pool = [f"pool line number {k} é" for k in range(40)] + ["short", "ten chars!", "ÄÄÄÄÄÄÄÄÄ", "ÄÄÄÄÄÄÄÄÄÄ", "", " ", "\x1cnot stripped\x1c"]
    rows = [(k, "\n".join([common.strip() if k % 3 else common] * (k % 2 + 1) + rng.sample(pool, 5) + [f"only in {k} and nowhere else"])) for k in range(3, 60)]
    rows += [(70, "\n".join(f"line {k} of a long text" for k in range(60000))), (71, "x" * 3_000_000 + "\nline 59999 of a long text"), (72, "x" * 3_000_000)]
    return [*rows, (5, common), (5, "another row of document five\n" + common), (None, None), (None, common + "\nnull twice here"), (None, "null twice here"), (80, ""), (81, None)]


@pytest.mark.parametrize("size", [None, 20])
def test_lines_go_where_another_document_has_them_first(spark, size):
    rows = line_rows()
    df = spark.createDataFrame([(t, i, 1, "k") for i, t in rows], "text string, doc_id long, key int, gone string").repartition(7)
    same(rows_of(line_dedup.drop_repeated_lines(df, bits=size), "doc_id", "n_lines", "n_dropped", "kept"), brute.line_dedup(rows))


def test_lines_of_odd_and_given_documents(spark, odd, docs):
    for df in (odd, docs):
        same(rows_of(line_dedup.drop_repeated_lines(df), "doc_id", "n_lines", "n_dropped", "kept"), brute.line_dedup(rows_of(df, "doc_id", "text")))
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_a_line_of_a_third_of_all_rows(spark):
    rows = [(k, f"hot line in a third\nrow {k} alone\n" + ("" if k % 3 else "every third document")) for k in range(9000)]
    got = rows_of(line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)), "doc_id", "n_lines", "n_dropped", "kept")
    same(got, brute.line_dedup(rows))


# -- search ----------------------------------------------------------------------------

def items_frame(spark, items):
    return spark.createDataFrame([(t, i, 0) for i, t in items], "text string, item_id long, score int")


def test_search_equals_scoring_every_document(spark, docs):
    rows = rows_of(docs, "doc_id", "text")
    items = {r[0]: r[1] for r in rows_of(spark.read.parquet(f"{SMALL}/benchmark.parquet"), "item_id", "text")}
    got = lexical_search.ranked_search(docs, items_frame(spark, items.items()), k=7, shard=40, sample=2, per_pass=9)
    same(rows_of(got, "item_id", "rank", "doc_id", "score"), brute.ranked(rows, items, 7))


def test_search_ties_nulls_and_long_texts(spark, odd):
    rows = rows_of(odd, "doc_id", "text") + [(k, "one two THREE") for k in range(100, 180)] + [(200, "one " * 300000 + "rare"), (201, "Ünï " * 200000)]
    items = {1: "One two two", None: "rare Ünï", 3: None, 4: "", 5: "unknownword", 6: "for i'm 1"}
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, n int, cols int, rank int")
    for options in ({}, {"shard": 30, "sample": 1, "per_pass": 2}):
        got = lexical_search.ranked_search(df, items_frame(spark, items.items()), **options)
        same(rows_of(got, "item_id", "rank", "doc_id", "score"), brute.ranked(rows, items))
    assert lexical_search.ranked_search(df.limit(0), items_frame(spark, items.items())).count() == 0
    assert lexical_search.ranked_search(df, items_frame(spark, items.items()).limit(0)).count() == 0


def test_items_with_one_id_are_one_item(spark, docs):
    got = lexical_search.ranked_search(docs, items_frame(spark, [(1, "the of"), (1, "and the")]), k=5)
    same(rows_of(got, "item_id", "rank", "doc_id", "score"), brute.ranked(rows_of(docs, "doc_id", "text"), {1: "the of and"}, 5))


def test_blocks_are_skipped_and_bounds_hold(docs):
    """Summary bounds are at least every member's score; a high floor opens few blocks."""
    rows = rows_of(docs, "doc_id", "text")
    texts = [t or "" for _, t in rows]
    items = {0: set(lexical_search.terms(texts[3].encode())[5:60]), 1: set(lexical_search.terms(texts[90].encode())[:40])}
    q = lexical_search.Queries(items)
    bags = [lexical_search.terms(t.encode()) for t in texts]
    cols, tfs, at = [], [], [0]
    for b in bags:
        found = sorted({q.vocabulary[t] for t in b if t in q.vocabulary})
        names = {v: k for k, v in q.vocabulary.items()}
        cols += found
        tfs += [b.count(names[c]) for c in found]
        at.append(len(cols))
    cols, tfs, at = np.array(cols), np.array(tfs), np.array(at)
    n = np.array([len(b) for b in bags])
    impact = lexical_search.impacts(tfs, np.repeat(n, np.diff(at)), int((n > 0).sum()), int(n.sum()))
    df = np.bincount(cols, minlength=len(q.vocabulary))
    peak = np.zeros(len(q.vocabulary), np.int64)
    np.maximum.at(peak, cols, impact)
    q.weigh(int((n > 0).sum()), int(n.sum()), df, peak)
    planes = np.random.default_rng(0).standard_normal((len(q.vocabulary), 16)).astype(np.float32)
    opened = []
    for share in (0.0, 0.6):
        scores = [lexical_search.Shard(q, q.essential(), at, cols, impact, planes).score(k, np.arange(len(rows))) for k in (0, 1)]
        q.floor = np.array([int(s.max() * share) for s in scores])
        shard = lexical_search.Shard(q, q.essential(), at, cols, impact, planes)
        for item, block, bound in zip(*shard.bounds()):
            members = shard.post[shard.starts[block]: shard.ends[block]]
            assert shard.score(int(item), members).max() <= bound
        item, doc, score, used = shard.search(5, np.arange(len(rows)))
        opened.append(used)
        for k in (0, 1):
            best = np.lexsort((np.arange(len(rows)), -scores[k]))[:5]
            want = [(int(d), int(scores[k][d])) for d in best if scores[k][d] >= max(1, q.floor[k])]
            assert [(int(d), int(s)) for i, d, s in zip(item, doc, score) if i == k] == want
    assert opened[1] < opened[0] < 2 * len(shard.starts) + len(rows)


# -- phrases ---------------------------------------------------------------------------

@pytest.mark.parametrize("n, width", [(2, 1), (2, 21), (3, 20), (4, 16), (5, 16), (5, 21), (3, 5)])
def test_quotient_filters_restore_and_merge_exactly(n, width):
    rng = np.random.default_rng(n * width)
    layout = quotient.Layout(n, width)
    words = rng.integers(0, min(1 << width, 50), (3000, n)).astype(np.uint32)
    words[0], words[1] = (1 << width) - 1, 0
    top, low = layout.pack([words[:, k] for k in range(n)])
    back = layout.unpack(top, low)
    assert all((b == words[:, k]).all() for k, b in enumerate(back))
    want = {}
    for w in map(tuple, words.tolist()):
        want[w] = want.get(w, 0) + 1
    for skip in (0, 1, min(layout.top, 4)):
        parts = {}
        for s in range(0, 3000, 1000):
            t, lo, c = quotient.counted(top[s: s + 1000], None if low is None else low[s: s + 1000])
            c = c * 1000 if s == 0 else c
            bucket = (t >> np.uint64(layout.top - skip)).astype(int) if skip else np.zeros(len(t), int)
            for b in set(bucket.tolist()):
                at = bucket == b
                data = quotient.pack_filter(layout, skip, t[at], None if lo is None else lo[at], c[at])
                parts.setdefault(b, []).append(quotient.unpack_filter(layout, skip, b, data))
        got = {}
        for p in parts.values():
            t, lo, c = quotient.merged(p)
            got |= dict(zip(zip(*(w.tolist() for w in layout.unpack(t, lo))), c.tolist()))
        first = {}
        for k, w in enumerate(map(tuple, words.tolist())):
            first[w] = first.get(w, 0) + (1000 if k < 1000 else 1)
        assert got == first and set(first) == set(want)


def test_packed_filters_are_compact():
    layout = quotient.Layout(4, 16)
    rng = np.random.default_rng(0)
    top, low, counts = quotient.counted(*layout.pack([rng.integers(0, 1 << 16, 100000, dtype=np.uint32) for _ in range(4)]))
    assert len(quotient.pack_filter(layout, 0, top, low, counts)) < 8 * len(top)


def phrase_rows():
    rng = random.Random(5)
    words = ["red", "Green", "blue", "grey-ish", "a", "É", "日本", "longlonglong" * 8, "x1"]
    texts = []
    for k in range(300):
        body = " ".join(rng.choices(words, [9, 8, 7, 2, 9, 3, 3, 2, 1], k=30))
        texts.append(rng.choice(["de", "en", None]) and ("de" if k % 3 else None, body.replace("blue", "blue,") + " new york  city\tcouncil meets! rare%d" % k))
    texts = [t if t else ("en", "a a a a a a; new york city") for t in texts]
    return texts + [("en", "a " * 400), ("en", None), (None, ""), ("fr", "seul"), ("en", "b " * 200000 + "\r\x0b\x0c.")]


@pytest.mark.parametrize("lexicon", [phrases.LEXICON_WORDS, 6, 0])
def test_phrases_equal_plain_counting(spark, lexicon):
    rows = phrase_rows()
    df = spark.createDataFrame([(t, 5, lang, 6) for lang, t in rows], "text string, n int, lang string, a int").repartition(5)
    got = phrases.collocations(df, 12, least=20, lexicon_words=lexicon)
    same(rows_of(got, "lang", "rank", "phrase", "a", "l", "r", "n", "score"), brute.collocations(rows, 12, 20))


def test_phrases_of_odd_and_given_documents(spark, odd, docs):
    for df, least in ((odd, 1), (docs, 10)):
        rows = rows_of(df, "lang", "text")
        got = phrases.collocations(df, 2000, least=least)
        same(rows_of(got, "lang", "rank", "phrase", "a", "l", "r", "n", "score"), brute.collocations(rows, 2000, least))
    assert phrases.collocations(docs.limit(0), 5).count() == 0


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([("en", "u v " * 100)], "lang string, text string")
    totals, words, grams = phrases.phrase_counts(df, 2)
    assert {(r["phrase"], r["a"]) for r in grams.collect()} >= {("u v", 100), ("v u", 99), ("u v u v u", 98)}
    big = spark.sql("select (cast(1000 as decimal(38, 0)) * 9000000000000L * 9000000000000L) div (cast(9000000000000L as decimal(19, 0)) * 9000000000L) as x").first()[0]
    assert big == 1000 * 9000000000000 * 9000000000000 // (9000000000000 * 9000000000)
