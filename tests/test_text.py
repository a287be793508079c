from pyspark.sql import functions as F

from sifter.functions import text as T


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "text string").select(col.alias("x")).first()["x"]


def test_readme_example(spark, params):
    # worked example of the original application
    out = one(spark, T.preprocess(F.col("text"), params), "Students are learning NLP and data science")
    assert out == "student learn nlp data science"


def test_normalize_deletes_characters(spark):
    assert one(spark, T.normalize(F.col("text")), "State-of-the-Art naïve 42 it's") == "stateoftheart nave  it's"


def test_tokens_clitics_and_length(spark, params):
    toks = one(spark, T.lemmas(F.col("text"), params), "John's dogs' 'quoted' xy don't")
    assert toks == ["john", "dog", "quot"]


def test_sentences_and_word_counts(spark):
    text = "  First one.  Second one!\n\nThird   has four words?  \n  "
    sents = one(spark, T.sentences(F.col("text")), text)
    assert sents == ["First one.", "Second one!", "Third   has four words?"]
    wc = one(spark, F.transform(T.sentences(F.col("text")), T.word_count), text)
    assert wc == [2, 2, 4]


def test_blank_text_has_no_sentences(spark):
    assert one(spark, T.sentences(F.col("text")), " \n\t ") == []


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (1.5,), (-0.2,), (0.3,)], "x double")
    assert [r[0] for r in df.select(T.clamp01(F.col("x"))).collect()] == [None, 1.0, 0.0, 0.3]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(T.ngrams_1_3(F.col("t"))).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_content_hash(spark):
    import hashlib
    assert one(spark, T.content_sha256(F.col("text")), "héllo") == hashlib.sha256("héllo".encode()).hexdigest()
