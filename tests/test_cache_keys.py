"""The cache's join: no sort of the vectors when no key is there twice, one row a text when one is."""

from sifter.operators import cache as K


def test_keys_of_the_cache(spark, params, tmp_path):
    path = f"{tmp_path}/cache"
    df = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "alpha beta"), (4, None)], "id bigint, text string")
    out = K.embed_with_cache(df, params, path)
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    want = sorted((r.id, r.emb) for r in out.collect())
    K.read_cache(spark, path, K.model_id(params)).limit(1).write.mode("append").partitionBy("model").parquet(path)  # a second writer
    assert K.read_cache(spark, path, K.model_id(params)).count() == 3
    assert sorted((r.id, r.emb) for r in K.embed_with_cache(df, params, path).collect()) == want
