import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sifter.operators import passages as G
from sifter.params import DEFAULT

SF_LARGE = "/root/testdata/sf0.1"


def plain_runs(a, b, least=8):
    """Maximal runs of equal words by trying every pair of places."""
    x, y = (re.findall(r"[^\W_]+", t.lower()) for t in (a, b))
    out = set()
    for shift in range(-len(x), len(y)):
        low = max(0, -shift)
        for i in range(low, len(x) + 1):
            if i == len(x) or i + shift >= len(y) or x[i] != y[i + shift]:
                if i - low >= least:
                    out.add((low, i, low + shift, i + shift))
                low = i + 1
                if i + shift >= len(y):
                    break
    return out


def texts(seed):
    r = random.Random(seed)
    pool = [f"w{k}" for k in range(6)]
    base = [r.choice(pool) for _ in range(60)]
    out = []
    for k in range(12):
        t = list(base)
        for _ in range(k):
            t[r.randrange(len(t))] = "other%d" % k
        out.append(" ".join(t[r.randrange(10):]) + " " + " ".join(r.choice(pool) for _ in range(20)))
    return [*out, "", "one two", "É É é, é! É é é é é", "a " * 40, "x" * 1000]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_maximal_run_is_found(spark, seed):
    a, b = texts(seed)[:8], texts(seed)
    left = spark.createDataFrame([*enumerate(a), (None, a[0]), (100, None)], "i long, text string")
    right = spark.createDataFrame([*enumerate(b), (None, b[0]), (100, None)], "j long, text string")
    got = {tuple(r) for r in G.matching_runs(left, right, "i", "j", DEFAULT).collect()}
    assert got == {(i, j, *r) for i, s in enumerate(a) for j, t in enumerate(b) for r in plain_runs(s, t)}


def test_winnowing_keeps_a_gram_of_every_guaranteed_run():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    _, at = G.winnowed(keys)
    kept = set(at.tolist())
    for s in range(len(keys) - G.GUARANTEE + 1):
        assert kept & set(range(s, s + G.GUARANTEE - G.GRAM + 1))
    assert len(kept) < len(keys) * 0.6
    assert [len(G.winnowed(keys[:n])[0]) for n in (0, 4, 5)] == [0, 0, 1]


def test_best_chain_equals_brute_force():
    r = random.Random(3)
    for _ in range(300):
        runs = []
        for _ in range(r.randrange(0, 9)):
            i, j, n = r.randrange(30), r.randrange(30), r.randrange(1, 9)
            runs.append((i, i + n, j, j + n))
        best = 0
        for mask in range(1 << len(runs)):
            some = sorted(x for k, x in enumerate(runs) if mask >> k & 1)
            if all(p[1] <= q[0] and p[3] <= q[2] for p, q in zip(some, some[1:])):
                best = max(best, sum(x[1] - x[0] for x in some))
        chain = G.best_chain(runs)
        assert all(p[1] <= q[0] and p[3] <= q[2] for p, q in zip(chain, chain[1:])) and set(chain) <= set(runs)
        assert sum(x[1] - x[0] for x in chain) == best


def test_fragments_span_their_gaps(spark):
    a = " ".join(f"a{k}" for k in range(40))
    b = " ".join(["before"] * 5 + [f"a{k}" for k in range(15)] + ["inserted"] * 7 + [f"a{k}" for k in range(20, 40)])
    one = spark.createDataFrame([(1, a)], "i long, text string")
    two = spark.createDataFrame([(2, b), (3, "nothing alike")], "j long, text string")
    runs = G.matching_runs(one, two, "i", "j", DEFAULT)
    assert [tuple(r) for r in G.chained_fragments(runs, "i", "j").collect()] == [(1, 2, 0, 40, 5, 47, 2, 35)]


def test_all_verbatim_passages_are_found_whatever_the_length(spark):
    con = duckdb.connect()
    want = con.sql(f"SELECT item_id, doc_id FROM '{SF_LARGE}/benchmark.parquet' b JOIN '{SF_LARGE}/documents.parquet/*.parquet' d ON contains(d.text, b.text)"
                   if __import__("os").path.isdir(f"{SF_LARGE}/documents.parquet") else
                   f"SELECT item_id, doc_id FROM '{SF_LARGE}/benchmark.parquet' b JOIN '{SF_LARGE}/documents.parquet' d ON contains(d.text, b.text)").fetchall()
    bench, docs = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("benchmark", "documents"))
    n = bench.select("item_id", F.size(G.words(F.col("text"))).alias("n"))
    runs = G.matching_runs(bench, docs, "item_id", "doc_id", DEFAULT).join(n, "item_id")
    whole = {tuple(r) for r in runs.where("left_end - left_start >= n - 2").select("item_id", "doc_id").collect()}
    assert len(want) >= 200 and set(want) <= whole
