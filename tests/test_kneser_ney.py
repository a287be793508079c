import re
from collections import Counter

import pytest

from sifter.operators import kneser_ney as N
from sifter.params import DEFAULT

TEXTS = ["the cat sat on the mat", "the cat ran", "the dog sat on the cat", "dogs and cats and dogs", "on the mat the dog sat", None, "", "the the the"]


def plain(texts):
    """p(w | u, v) and the vocabulary, straight from the definition."""
    c3 = Counter()
    for t in texts:
        s = ["<s>", "<s>", *re.findall(r"[^\W_]+", (t or "").lower())]
        c3.update(zip(s, s[1:], s[2:]))
    c2 = Counter((v, w) for _, v, w in c3)
    c1 = Counter(w for _, w in c2)

    def discount(c):
        n = Counter(c.values())
        return max(0.1, n[1] / (n[1] + 2 * n[2])) if n[1] + n[2] else 0.5

    d1, d2, d3 = map(discount, (c1, c2, c3))

    def p(u, v, w):
        total = sum(c1.values())
        out = max(c1[w] - d1, 0) / total + d1 * len(c1) / total / (len(c1) + 1)
        for counts, key, d in ((c2, (v,), d2), (c3, (u, v), d3)):
            after = {g: n for g, n in counts.items() if g[:-1] == key}
            if after:
                total = sum(after.values())
                out = max(counts[(*key, w)] - d, 0) / total + d * len(after) / total * out
        return out

    return p, set(c1)


@pytest.fixture(scope="module")
def model(spark):
    return N.fit(spark.createDataFrame([(t,) for t in TEXTS], "text string"), DEFAULT)


def test_probabilities_equal_the_definition_and_sum_to_one(spark, model):
    p, vocabulary = plain(TEXTS)
    contexts = [("<s>", "<s>"), ("the", "cat"), ("on", "the"), ("never", "the"), ("never", "seen"), ("the", "the")]
    rows = [(u, v, w) for u, v in contexts for w in [*sorted(vocabulary), "unseenword"]]
    got = {(r.u, r.v, r.w): r.p for r in N.probabilities(spark.createDataFrame(rows, "u string, v string, w string"), model, DEFAULT).collect()}
    assert all(got[g] == pytest.approx(p(*g)) for g in rows)
    for u, v in contexts:
        assert sum(x for g, x in got.items() if g[:2] == (u, v)) == pytest.approx(1)


def test_perplexity_of_rows(spark, model):
    import math

    p, _ = plain(TEXTS)
    rows = [(1, "the cat sat"), (2, None), (3, "x"), (4, "zebra zebra"), (5, "the cat sat the cat sat")]
    got = {r.i: r.perplexity for r in N.perplexity(spark.createDataFrame(rows, "i long, text string"), ["i"], model, DEFAULT).collect()}
    for i, t in rows:
        s = ["<s>", "<s>", *re.findall(r"[^\W_]+", (t or "").lower())]
        logs = [math.log(p(*g)) for g in zip(s, s[1:], s[2:])]
        assert got[i] == (pytest.approx(math.exp(-sum(logs) / len(logs))) if logs else None)


def test_model_of_an_empty_table(spark):
    none = spark.createDataFrame([], "text string")
    model = N.fit(none, DEFAULT)
    got = N.perplexity(spark.createDataFrame([(1, "any words")], "i long, text string"), ["i"], model, DEFAULT).collect()
    assert got[0].perplexity == pytest.approx(1)


def test_texts_are_cut_and_shuffled_once(spark):
    train = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    model = N.fit(train, DEFAULT)
    rows = spark.createDataFrame([("the", "cat", "sat")], "u string, v string, w string")
    for df in (model.trigrams, model.contexts, model.pairs, model.words, model.unigrams, N.probabilities(rows, model, DEFAULT)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" not in plan and plan.count("Join") <= 3
