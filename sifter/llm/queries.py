"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm import (bpe_lexicon, decontaminate, knn_join, langid, lexical_search, line_dedup, phrases, pii, quality, ring, simhash,
                        suffix_dedup, token_files)
from sifter.llm.common import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe_lexicon.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"], decode=True)
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.knn_join(_table(spark, sf_dir, "embeddings"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.repeated_bytes(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return rows.select("doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (lang declared, source as host) and pages (lang attribute, address) with one
    text model trained on the documents: doc_id or page_id, lang_id, lang_p, lang_ok."""
    docs, pages = _table(spark, sf_dir, "documents"), langid.from_page(_table(spark, sf_dir, "pages"))
    model = langid.train(docs, "text", "lang")
    one = langid.identify(docs.select("doc_id", "text", "lang", "source"), model, "text", declared="lang", host="source")
    two = langid.identify(pages.select("page_id", "text", "declared", "suffix", "host"), model, "text", "declared", "suffix", "host")
    answer = ["lang_id", "lang_p", "lang_ok"]
    return (one.select("doc_id", F.lit(None).cast("long").alias("page_id"), *answer)
            .unionByName(two.select(F.lit(None).cast("long").alias("doc_id"), "page_id", *answer)))


def op7_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = written(pii.annotate(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "pii")
    found = pii.decide(found, pii.fit(found))
    counts = [F.size(F.filter("pii_base", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined("pii_base").cast("binary"), 256).alias("base_sha256"), pii.joined("pii_spans").alias("spans"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.store(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ring.shard_rows(_table(spark, sf_dir, "documents"))
    return rows.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), 2000)


QUERIES = {f.__name__: f for f in (
    op1_bpe_lexicon, op2_voronoi_knn, op3_suffix_dedup, op4_subword_quality, op5_decontaminate,
    op6_language_fusion, op7_weak_pii, op8_token_files, op9_simhash_neardup, op10_ring_sharding,
    op11_line_dedup, op12_lexical_search, op13_collocations)}

#: Hashing, tokenising and training have no SQL form; tests compare those with brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_voronoi_knn": """
        WITH fine AS (
            SELECT vec_id, list_transform(embedding, x -> floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM fine q JOIN fine c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op5_decontaminate": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
        ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM d)),
        bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM b)),
        n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
        s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (g) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
        FROM s JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles""",
    "op11_line_dedup": r"""
        WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
                   FROM documents),
        k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) <> max(doc_id)),
        m AS (SELECT k.*, r.key IS NOT NULL AND r.first <> doc_id AS gone FROM k LEFT JOIN r USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op12_lexical_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        c AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS nd, sum(len(ts))::BIGINT AS nt FROM d),
        p AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(ts)::BIGINT AS n, unnest(ts) AS term FROM d) GROUP BY doc_id, term),
        f AS (SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY term),
        s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt))))::BIGINT AS score
              FROM b JOIN p USING (term) JOIN f USING (term), c GROUP BY item_id, doc_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50""",
    "op13_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                                      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) AS s(k))),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase),
        n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 100),
        t AS (SELECT lang, phrase, k, a, j, array_to_string(w[1:j], ' ') AS one, array_to_string(w[j + 1:k], ' ') AS two FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
        s AS (SELECT t.lang, t.phrase, t.k, t.a, j, x.a AS l, y.a AS r, n, ((1000::HUGEINT * t.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
              FROM t JOIN f x ON x.lang = t.lang AND x.phrase = one JOIN f y ON y.lang = t.lang AND y.phrase = two JOIN n ON n.lang = t.lang),
        m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        o AS (SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = m.lang AND c.k > m.k AND 100 * c.a >= 100 * m.a
                                                  AND contains(' ' || c.phrase || ' ', ' ' || m.phrase || ' '))),
        z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
        SELECT lang, rank, phrase, a, l, r, n, score FROM z WHERE rank <= 2000""",
}
