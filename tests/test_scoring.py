import pytest
from pyspark.sql import functions as F

from sifter.operators import aiscore as D
from sifter.operators import scoring as S


def test_levels_at_boundaries(spark, params):
    df = spark.createDataFrame([(0.45,), (0.451,), (0.75,), (0.751,), (0.0,)], "s double")
    got = [r[0] for r in df.select(S.level(F.col("s"), params)).collect()]
    assert got == ["Bajo", "Medio", "Medio", "Alto", "Bajo"]


def test_blend_uses_unrounded_parts(spark, params):
    df = spark.createDataFrame([(0.1004, 0.2004, 0.3004)], "lex double, mh double, sem double")
    got = df.select(S.blend(F.col("lex"), F.col("mh"), F.col("sem"), params)).first()[0]
    assert got == round(0.25 * 0.1004 + 0.15 * 0.2004 + 0.60 * 0.3004, 3)


def test_burstiness(spark):
    df = spark.createDataFrame([("Only one sentence here",), ("One two. One two three four.",), ("",)], "text string")
    got = [r[0] for r in df.select(D.burstiness(F.col("text"))).collect()]
    assert got[0] == 0.0 and got[2] == 0.0
    assert got[1] == pytest.approx(1.0 / (3.0 + 1e-9))  # std([2, 4]) / mean


def test_ai_label_threshold(spark, params):
    # one sentence -> burstiness 0, so score = (1 - p/200) * 0.6 + 0.4
    texts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, text string")
    ppl = spark.createDataFrame([(1, 133.2), (2, 134.0), (3, None)], "id bigint, perplexity double")
    got = {r.id: r for r in D.ai_score(texts, "id", ppl, params).collect()}
    # 0.6004 is shown as 0.6 but the label tests the unrounded score
    assert got[1].ai_probability == 0.6 and got[1].ai_label == "Probable IA"
    assert got[2].ai_probability == 0.598 and got[2].ai_label == "Probable humano"
    assert got[3].ai_probability is None and got[3].ai_label is None


def test_bigram_perplexity(spark, params):
    train = spark.createDataFrame([("a b a b a b",), ("a b c",)], "text string")
    m = D.fit_bigram_model(train, params)
    assert m.vocab == 4  # a, b, c + unknown
    texts = spark.createDataFrame([(1, "a b"), (2, "z"), (3, "b a")], "id bigint, text string")
    got = {r.id: r.perplexity for r in D.perplexity(texts, "id", m, params).collect()}
    # p(b|a) = (4 + 1) / (4 + 4)
    assert got[1] == pytest.approx(8 / 5)
    assert got[2] is None
    assert got[3] == pytest.approx(1 / ((2 + 1) / (3 + 4)))
