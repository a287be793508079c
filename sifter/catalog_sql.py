"""DuckDB statements equivalent to every registered query of ``sifter.catalog``.

Column names and types match the Spark results. The statements restate each
operator's definition directly (brute force where that is simplest, e.g. every
query chunk against every corpus chunk), so they check the Spark plans
independently.
"""

from __future__ import annotations

from sifter.catalog import P, PAIR_MIN_LEX
from sifter.operators.cache import model_id
from sifter.sqlref import (ai_cte, burst_of, chunks_cte, dbl, dots_cte, hash_emb_cte, lemma_case, lemmas_expr,
                           lm_ctes, mh_cte, normalize_expr, processed_cte, s, sents_cte, sig_cte, tf_cte,
                           tfidf_cte, token_cte, wc_list_expr, with_, with_rec)
from sifter.functions import text as T

CU = "struct_pack(i := id, c := chunk_no)"  # a chunk's key
MSG = "struct_pack(i := conv_id, t := turn)"  # a message's key
DIM = P.embedding_dim

# T8 by learned boundaries, restated: words with and without a final stop, then the rule's pieces.
SPACE = "[@]".replace("@", T.WS)
ABBREVIATIONS = (
    r"""wtok AS (
  SELECT lower(regexp_extract(x, '^[("''\[]*(\p{L}+(?:\.\p{L}+)*)(\.?)[,;:)"''\]]*$', 1)) AS word,
         regexp_extract(x, '^[("''\[]*(\p{L}+(?:\.\p{L}+)*)(\.?)[,;:)"''\]]*$', 2) AS stop
  FROM (SELECT unnest(string_split_regex(coalesce(text, ''), '@+')) AS x FROM documents) a)""".replace("@", SPACE),
    """wcnt AS (SELECT word, count(*) AS n, count(*) FILTER (WHERE stop = '.') AS k FROM wtok WHERE word <> '' GROUP BY word)""",
    """wall AS (SELECT CAST(sum(n) AS DOUBLE) AS tn, least(CAST(sum(k) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 1 - 1e-9) AS p FROM wcnt)""",
    """wsc AS (
  SELECT word, n, k, length(replace(word, '.', '')) AS len, length(word) - length(replace(word, '.', '')) AS inn,
         2 * (k * ln(CAST(0.99 AS DOUBLE)) + (n - k) * ln(1 - CAST(0.99 AS DOUBLE)) - k * ln(p) - (n - k) * ln(1 - p)) AS ratio
  FROM wcnt, wall WHERE k > 0)""",
    """abbr AS (SELECT * FROM (
  SELECT word, n, k, ratio * exp(-CAST(len AS DOUBLE)) * (inn + 1) * pow(CAST(len AS DOUBLE), CAST(k - n AS DOUBLE)) AS score FROM wsc) a
  WHERE score >= 0.3)""")
BOUNDARIES = (
    r"""lns AS (
  SELECT doc_id, generate_subscripts(l, 1) AS line, unnest(l) AS x
  FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '\n+') AS l FROM documents) a)""",
    r"""cut AS (
  SELECT doc_id, line, list_filter(list_transform(string_split(regexp_replace(x, '([.!?])@+', '\1' || chr(10), 'g'), chr(10)),
         lambda y: regexp_replace(y, '^@+|@+$', '', 'g')), lambda y: y <> '') AS c FROM lns)""".replace("@", SPACE),
    """pcs AS (SELECT doc_id, line, generate_subscripts(c, 1) AS piece, unnest(c) AS t FROM cut WHERE len(c) > 0)""",
    r"""nxt AS (
  SELECT *, regexp_extract(t, '(?:^|[("''\[@])(\p{L}+(?:\.\p{L}+)*)\.$', 1) AS lst,
         regexp_extract(f, '^[("''\[]*(\p{L}+)', 1) AS fst
  FROM (SELECT *, lead(t) OVER (PARTITION BY doc_id, line ORDER BY piece) AS f FROM pcs) a)""".replace("@", T.WS),
    r"""mrk AS (
  SELECT *, lower(lst) IN (SELECT word FROM abbr) OR regexp_matches(lst, '^\p{Lu}$') AS short FROM nxt)""",
    """str AS (SELECT lower(fst) AS word, count(*) AS c FROM mrk WHERE f IS NOT NULL AND NOT short GROUP BY 1)""",
    """stt AS (
  SELECT word, CAST(c AS DOUBLE) AS c, CAST(n AS DOUBLE) AS n, tn AS t, CAST((SELECT sum(c) FROM str) AS DOUBLE) AS m
  FROM str JOIN wcnt USING (word), wall)""",
    """big AS (
  SELECT word FROM stt WHERE c <= n AND n < t AND m < t AND c * t > n * m AND 2 * (
    c * ln(c / m) + CASE WHEN m > c THEN (m - c) * ln(1 - c / m) ELSE 0 END
    + CASE WHEN n > c THEN (n - c) * ln((n - c) / (t - m)) ELSE 0 END + CASE WHEN t - m > n - c THEN (t - m - n + c) * ln(1 - (n - c) / (t - m)) ELSE 0 END
    - c * ln(n / t) - (m - c) * ln(1 - n / t) - (n - c) * ln(n / t) - (t - m - n + c) * ln(1 - n / t)) >= 30)""",
    r"""opn AS (
  SELECT *, f IS NOT NULL AND short AND NOT (lower(fst) IN (SELECT word FROM big) AND regexp_matches(fst, '^\p{Lu}')) AS o FROM mrk)""",
    """beg AS (SELECT *, CASE WHEN lag(o) OVER (PARTITION BY doc_id ORDER BY line, piece) THEN 0 ELSE 1 END AS b FROM opn)""",
    """sents AS (
  SELECT doc_id, piece, t, CAST(sum(b) OVER (PARTITION BY doc_id ORDER BY line, piece) - 1 AS BIGINT) AS sent_no FROM beg)""")


def _raw_tokens(text: str) -> str:
    return (f"list_transform(regexp_extract_all({normalize_expr(text)}, {s(T.TOKEN_RE)}), "
            f"lambda t: regexp_replace(t, {s(T.CLITIC_RE)}, '', 'g'))")


def _kept(text: str) -> str:
    stop = "[" + ", ".join(s(w) for w in P.stopwords) + "]"
    return (f"list_filter({_raw_tokens(text)}, lambda t: length(t) >= {P.min_token_chars} "
            f"AND NOT list_contains({stop}, t))")


LEX = [processed_cte("qp", "benchmark", "item_id"), processed_cte("dp", "documents", "doc_id"),
       tf_cte("qtf", "qp"), tf_cte("dtf", "dp"), tfidf_cte("lx", "qtf", "dtf")]
SIGS = [processed_cte("qp", "benchmark", "item_id"), processed_cte("dp", "documents", "doc_id"),
        token_cte("qtok", "qp"), token_cte("dtok", "dp"), sig_cte("qsig", "qtok"), sig_cte("dsig", "dtok")]
LEX_SIGS = LEX + [token_cte("qtok", "qp"), token_cte("dtok", "dp"), sig_cte("qsig", "qtok"), sig_cte("dsig", "dtok")]
CHUNKS_Q = [sents_cte("qs", "benchmark", "item_id"), chunks_cte("qch", "qs", "benchmark", "item_id")]
CHUNKS_D = [sents_cte("ds", "documents", "doc_id"), chunks_cte("dch", "ds", "documents", "doc_id")]
DOC_EMB = [hash_emb_cte("qde", "(SELECT item_id AS uid, text AS txt FROM benchmark)", DIM),
           hash_emb_cte("dde", "(SELECT doc_id AS uid, text AS txt FROM documents)", DIM),
           dots_cte("ddot", "qde", "dde"),
           "dcos AS (SELECT b.item_id, d.doc_id, round(coalesce(x.dot, 0.0), 12) AS doc_cos "
           "FROM benchmark b CROSS JOIN documents d LEFT JOIN ddot x ON x.l = b.item_id AND x.r = d.doc_id)"]
CHUNK_EMB = [hash_emb_cte("qce", f"(SELECT {CU} AS uid, chunk AS txt FROM qch)", DIM),
             hash_emb_cte("dce", f"(SELECT {CU} AS uid, chunk AS txt FROM dch)", DIM)]
HITS = CHUNKS_Q + CHUNKS_D + CHUNK_EMB + [
    dots_cte("cdot", "qce", "dce"),
    f"""csc AS (SELECT q.uid AS q_uid, d.uid AS d_uid, round(coalesce(x.dot, 0.0), 12) AS score
  FROM (SELECT {CU} AS uid FROM qch) q CROSS JOIN (SELECT {CU} AS uid FROM dch) d
  LEFT JOIN cdot x ON x.l = q.uid AND x.r = d.uid)""",
    f"""hits AS (SELECT q_uid.i AS item_id, d_uid.i AS doc_id, avg(score) AS hit_mean, count(*) AS n_hits
  FROM (SELECT *, row_number() OVER (PARTITION BY q_uid ORDER BY score DESC, d_uid) AS rk FROM csc) t
  WHERE rk <= {P.corpus_search_k} GROUP BY ALL)"""]
SEM = DOC_EMB + HITS + [
    """sem AS (SELECT c.item_id, c.doc_id,
  CASE WHEN coalesce(h.hit_mean, c.doc_cos) IS NULL THEN NULL
       ELSE greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), coalesce(h.hit_mean, c.doc_cos))) END AS sem,
  coalesce(h.n_hits, 0) AS n_hits
  FROM dcos c LEFT JOIN hits h ON h.item_id = c.item_id AND h.doc_id = c.doc_id)"""]


def _final(lex: str, mh: str, sem: str) -> str:
    return (f"round({dbl(P.weight_tfidf)} * {lex} + {dbl(P.weight_minhash)} * {mh} "
            f"+ {dbl(P.weight_semantic)} * {sem}, 3)")


def _level(x: str) -> str:
    hi, mid, lo = P.level_labels
    return (f"CASE WHEN {x} > {dbl(P.level_high)} THEN {s(hi)} WHEN {x} > {dbl(P.level_medium)} "
            f"THEN {s(mid)} ELSE {s(lo)} END")


CORPUS = LEX_SIGS + SEM + ai_cte("aiq", "benchmark", "item_id") + [
    "mhs AS (SELECT q.id AS q_id, d.id AS d_id, count(*) / CAST(128.0 AS DOUBLE) AS mh FROM qsig q JOIN dsig d "
    "ON q.slot = d.slot AND q.val = d.val GROUP BY q.id, d.id)",
    f"""parts AS (SELECT m.item_id, m.doc_id, coalesce(l.lex, 0.0) AS lex,
  CASE WHEN m.item_id NOT IN (SELECT id FROM qsig) AND m.doc_id NOT IN (SELECT id FROM dsig) THEN 1.0
       ELSE coalesce(h.mh, 0.0) END AS mh, m.sem, m.n_hits
  FROM sem m LEFT JOIN lx l ON l.q_id = m.item_id AND l.d_id = m.doc_id
  LEFT JOIN mhs h ON h.q_id = m.item_id AND h.d_id = m.doc_id)""",
    f"""scored AS (SELECT p.item_id, p.doc_id, round(p.lex, 3) AS lex_score, round(p.mh, 3) AS minhash_score,
  round(p.sem, 3) AS semantic_score, {_final('p.lex', 'p.mh', 'p.sem')} AS final_score,
  {_level(_final('p.lex', 'p.mh', 'p.sem'))} AS level, p.n_hits, dd.source, a.perplexity, a.burstiness, a.ai_probability,
  a.ai_label FROM parts p LEFT JOIN aiq a ON a.id = p.item_id LEFT JOIN documents dd ON dd.doc_id = p.doc_id)""",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY final_score DESC, doc_id) AS rank "
    "FROM scored)"]

#: Equal words on a diagonal, and islands of neighbours on it.
PASSAGE_RUNS = r"""
        WITH b AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w,
                          generate_subscripts(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 1) - 1 AS p FROM benchmark),
        d AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w,
                     generate_subscripts(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 1) - 1 AS p FROM documents),
        m AS (SELECT item_id, doc_id, b.p AS p, d.p - b.p AS shift FROM b JOIN d USING (w)),
        g AS (SELECT *, p - row_number() OVER (PARTITION BY item_id, doc_id, shift ORDER BY p) AS island FROM m)
        SELECT item_id, doc_id, min(p)::INT AS left_start, (max(p) + 1)::INT AS left_end, (min(p) + shift)::INT AS right_start, (max(p) + 1 + shift)::INT AS right_end
        FROM g GROUP BY item_id, doc_id, shift, island HAVING count(*) >= 8"""

#: Interpolated Kneser-Ney, each order written out for every scored trigram.
KNESER_NEY = r"""
        WITH tr AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
        tt AS (SELECT list_concat(['<s>', '<s>'], t) AS s, unnest(range(1, len(t) + 1)) AS i FROM tr),
        c3 AS (SELECT s[i] AS u, s[i + 1] AS v, s[i + 2] AS w, count(*) AS n FROM tt GROUP BY ALL),
        c2 AS (SELECT v, w, count(*) AS n FROM c3 GROUP BY v, w),
        c1 AS (SELECT w, count(*) AS n FROM c2 GROUP BY w),
        dd AS (SELECT greatest(0.1::DOUBLE, (SELECT count(*) FROM c3 WHERE n = 1)::DOUBLE / (SELECT count(*) FILTER (WHERE n = 1) + 2 * count(*) FILTER (WHERE n = 2) FROM c3)) AS d3,
                      greatest(0.1::DOUBLE, (SELECT count(*) FROM c2 WHERE n = 1)::DOUBLE / (SELECT count(*) FILTER (WHERE n = 1) + 2 * count(*) FILTER (WHERE n = 2) FROM c2)) AS d2,
                      greatest(0.1::DOUBLE, (SELECT count(*) FROM c1 WHERE n = 1)::DOUBLE / (SELECT count(*) FILTER (WHERE n = 1) + 2 * count(*) FILTER (WHERE n = 2) FROM c1)) AS d1,
                      (SELECT sum(n) FROM c1)::DOUBLE AS total, (SELECT count(*) FROM c1)::DOUBLE AS kinds),
        x3 AS (SELECT u, v, sum(n)::DOUBLE AS total, count(*) AS kinds FROM c3 GROUP BY u, v),
        x2 AS (SELECT v, sum(n)::DOUBLE AS total, count(*) AS kinds FROM c2 GROUP BY v),
        q AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM conversations),
        qq AS (SELECT conv_id, turn, list_concat(['<s>', '<s>'], t) AS s, unnest(range(1, len(t) + 1)) AS i FROM q),
        g AS (SELECT conv_id, turn, s[i] AS u, s[i + 1] AS v, s[i + 2] AS w FROM qq),
        p1 AS (SELECT g.*, greatest(coalesce(c1.n, 0) - d1, 0) / dd.total + d1 * dd.kinds / dd.total / (dd.kinds + 1) AS p1, d2, d3
               FROM g CROSS JOIN dd LEFT JOIN c1 ON c1.w = g.w),
        p2 AS (SELECT p1.*, CASE WHEN x2.v IS NULL THEN p1 ELSE greatest(coalesce(c2.n, 0) - d2, 0) / x2.total + d2 * x2.kinds / x2.total * p1 END AS p2
               FROM p1 LEFT JOIN x2 ON x2.v = p1.v LEFT JOIN c2 ON c2.v = p1.v AND c2.w = p1.w),
        p3 AS (SELECT p2.*, CASE WHEN x3.v IS NULL THEN p2 ELSE greatest(coalesce(c3.n, 0) - d3, 0) / x3.total + d3 * x3.kinds / x3.total * p2 END AS p3
               FROM p2 LEFT JOIN x3 ON x3.u = p2.u AND x3.v = p2.v LEFT JOIN c3 ON c3.u = p2.u AND c3.v = p2.v AND c3.w = p2.w),
        m AS (SELECT conv_id, turn, exp(-avg(ln(p3))) AS perplexity FROM p3 GROUP BY conv_id, turn)
        SELECT q.conv_id, q.turn, round(m.perplexity, 6) AS perplexity FROM q LEFT JOIN m ON m.conv_id = q.conv_id AND m.turn = q.turn"""

PAIRS = LEX + CHUNKS_Q + CHUNKS_D + CHUNK_EMB + [
    f"pairs AS (SELECT q_id AS a_id, d_id AS b_id FROM lx WHERE round(lex, 9) >= {PAIR_MIN_LEX} UNION SELECT item_id, doc_id FROM ({PASSAGE_RUNS}) t)",
    f"""pc AS (SELECT p.a_id, p.b_id, struct_pack(i := a.id, c := a.chunk_no) AS a_uid, struct_pack(i := b.id, c := b.chunk_no) AS b_uid,
  a.chunk_no AS a_chunk, b.chunk_no AS b_chunk, a.chunk AS frag_a, b.chunk AS frag_b
  FROM pairs p JOIN qch a ON a.id = p.a_id JOIN dch b ON b.id = p.b_id)""",
    "pcu AS (SELECT DISTINCT a_uid AS l, b_uid AS r FROM pc)",
    dots_cte("pdot", "qce", "dce", pairs="pcu"),
    """ps AS (SELECT pc.*, round(coalesce(x.dot, 0.0), 12) AS cosine FROM pc
  LEFT JOIN pdot x ON x.l = pc.a_uid AND x.r = pc.b_uid)""",
    f"""f1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a_id, b_id, a_uid ORDER BY cosine DESC, b_uid)
  AS hit_rank FROM ps) t WHERE hit_rank <= {P.pair_search_k} AND cosine > {dbl(P.fragment_threshold)})"""]


def _top(score_expr: str) -> list[str]:
    return [f"""fs AS (SELECT *, greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), {score_expr})) AS score
  FROM f1)""",
            f"""ft AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a_id, b_id ORDER BY score DESC, a_chunk,
  hit_rank) AS frag_rank FROM fs) t WHERE frag_rank <= {P.fragments_kept})"""]


def _jacc_score() -> str:
    ta = f"list_distinct(regexp_extract_all(lower(frag_a), {s(T.VECTOR_TOKEN_RE)}))"
    tb = f"list_distinct(regexp_extract_all(lower(frag_b), {s(T.VECTOR_TOKEN_RE)}))"
    union = f"len(list_distinct(list_concat({ta}, {tb})))"
    j = (f"(CASE WHEN {union} = 0 THEN CAST(0.0 AS DOUBLE) "
         f"ELSE CAST(len(list_intersect({ta}, {tb})) AS DOUBLE) / {union} END)")
    return f"round(greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), {j} / {dbl(P.rerank_scale)})), 3)"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["normalize_text"] = f"SELECT doc_id, {normalize_expr('text')} AS normalized FROM documents"
    q["tokenize"] = (f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens "
                     f"FROM (SELECT doc_id, {_raw_tokens('text')} AS t FROM documents) x")
    q["preprocess_tokens"] = (f"SELECT doc_id, CAST(len(k) AS BIGINT) AS n_kept, array_to_string(k, ' ') AS kept "
                              f"FROM (SELECT doc_id, {_kept('text')} AS k FROM documents) x")
    q["lemmatize"] = (f"SELECT token, {lemma_case('token')} AS lemma, count(*) AS n FROM "
                      f"(SELECT unnest({_kept('text')}) AS token FROM documents) x GROUP BY token")
    q["preprocess_text"] = (f"SELECT doc_id, array_to_string(l, ' ') AS processed, CAST(len(l) AS BIGINT) AS n_lemmas "
                            f"FROM (SELECT doc_id, {lemmas_expr('text')} AS l FROM documents) x")
    q["split_sentences"] = with_(sents_cte("ds", "documents", "doc_id")) + \
        "SELECT id AS doc_id, CAST(i AS BIGINT) AS sent_no, sent FROM ds"
    q["sentence_lengths"] = with_(sents_cte("ds", "documents", "doc_id")) + \
        "SELECT id AS doc_id, CAST(i AS BIGINT) AS sent_no, CAST(wc AS BIGINT) AS n_words FROM ds"
    q["abbreviations"] = with_(*ABBREVIATIONS) + "SELECT word, n, k, round(score, 6) AS score FROM abbr"
    q["split_sentences_learned"] = with_(*ABBREVIATIONS, *BOUNDARIES) + (
        "SELECT doc_id, sent_no, string_agg(t, ' ' ORDER BY piece) AS sent FROM sents GROUP BY doc_id, sent_no")
    q["content_keys"] = (f"SELECT doc_id, sha256(text) AS text_sha256, {s('emb:' + model_id(P) + ':')} || sha256(text) "
                         f"AS cache_key FROM documents")
    q["chunk_documents"] = with_rec(*CHUNKS_D) + \
        "SELECT id AS doc_id, chunk_no, first_sent, last_sent, n_words, chunk FROM dch"
    q["chunk_stats"] = with_rec(*CHUNKS_D) + \
        ("SELECT id AS doc_id, count(*) AS n_chunks, CAST(sum(n_words) AS BIGINT) AS total_words, "
         "CAST(max(n_words) AS BIGINT) AS max_words FROM dch GROUP BY id")
    q["ngram_counts"] = with_(processed_cte("dp", "documents", "doc_id"), tf_cte("dtf", "dp")) + \
        "SELECT id AS doc_id, term, tf FROM dtf"
    q["tfidf_pair_similarity"] = with_(*LEX) + "SELECT q_id AS item_id, d_id AS doc_id, round(lex, 9) AS lex FROM lx"
    q["minhash_signature"] = with_(*SIGS) + \
        "SELECT id AS doc_id, CAST(slot AS INTEGER) AS slot, val AS minhash FROM dsig"
    q["minhash_similarity"] = with_(*SIGS, mh_cte("mhs", "qsig", "dsig")) + \
        "SELECT q_id AS item_id, d_id AS doc_id, matches, mh FROM mhs"
    q["jaccard_similarity"] = with_(*SIGS[:4]) + """SELECT sh.item_id, sh.doc_id, sh.shared,
  round(CAST(sh.shared AS DOUBLE) / (qn.n + dn.n - sh.shared), 9) AS jaccard
FROM (SELECT q.id AS item_id, d.id AS doc_id, count(*) AS shared FROM qtok q JOIN dtok d ON q.token = d.token
      GROUP BY q.id, d.id) sh
JOIN (SELECT id, count(*) AS n FROM qtok GROUP BY id) qn ON qn.id = sh.item_id
JOIN (SELECT id, count(*) AS n FROM dtok GROUP BY id) dn ON dn.id = sh.doc_id"""
    q["passage_runs"] = PASSAGE_RUNS
    q["kneser_ney_perplexity"] = KNESER_NEY
    rows = P.minhash_perms // P.lsh_bands
    q["minhash_lsh_candidates"] = with_(*SIGS, *[
        f"{n}b AS (SELECT id, CAST(slot // {rows} AS INTEGER) AS band, "
        f"md5(string_agg(CAST(val AS VARCHAR), ',' ORDER BY slot)) AS key FROM {n} GROUP BY id, slot // {rows})"
        for n in ("qsig", "dsig")]) + \
        ("SELECT q.id AS item_id, d.id AS doc_id, count(*) AS n_bands FROM qsigb q JOIN dsigb d "
         "ON q.band = d.band AND q.key = d.key GROUP BY q.id, d.id")
    q["hash_embedding"] = with_(hash_emb_cte("he", "(SELECT doc_id AS uid, text AS txt FROM documents)", DIM)) + \
        ("SELECT uid AS doc_id, CAST(bucket AS INTEGER) AS bucket, CAST(cnt AS BIGINT) AS cnt, "
         "CAST(weight AS DOUBLE) AS weight FROM he")
    q["mean_pool"] = """WITH cells AS (SELECT label, CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS dim,
  unnest(embedding) AS x FROM embeddings),
m AS (SELECT label, dim, avg(CAST(x AS DOUBLE)) AS m FROM cells GROUP BY label, dim),
n AS (SELECT label, sqrt(sum(m * m)) AS norm FROM m GROUP BY label)
SELECT m.label, m.dim, round(CASE WHEN n.norm > 0 THEN m.m / n.norm ELSE m.m END, 6) AS value
FROM m JOIN n ON n.label = m.label"""
    q["normalize_vectors"] = """WITH v AS (SELECT vec_id, embedding AS e,
  sqrt(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda a, b: a + b))
  AS nrm FROM embeddings),
u AS (SELECT vec_id, CASE WHEN nrm > 0 THEN list_transform(e, lambda x: CAST(CAST(x AS DOUBLE) / nrm AS FLOAT))
  ELSE e END AS u FROM v)
SELECT vec_id, CAST(unnest(generate_series(0, len(u) - 1)) AS INTEGER) AS dim, CAST(unnest(u) AS DOUBLE) AS value
FROM u"""
    q["vector_topk"] = f"""SELECT q_vec_id, vec_id, rank, round(score, 6) + CAST(0.0 AS DOUBLE) AS score FROM (
  SELECT q_vec_id, vec_id, score, row_number() OVER (PARTITION BY q_vec_id ORDER BY score DESC, vec_id) AS rank
  FROM (SELECT a.vec_id AS q_vec_id, b.vec_id,
               round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 12) AS score
        FROM embeddings a CROSS JOIN embeddings b) x) y
WHERE rank <= {P.pair_search_k}"""
    q["doc_semantic_similarity"] = with_(*DOC_EMB) + \
        "SELECT item_id, doc_id, round(doc_cos, 6) + CAST(0.0 AS DOUBLE) AS doc_cos FROM dcos"
    q["corpus_semantic_hits"] = with_rec(*HITS) + \
        "SELECT item_id, doc_id, round(hit_mean, 6) AS hit_mean, n_hits FROM hits"
    q["corpus_semantic_score"] = with_rec(*SEM) + "SELECT item_id, doc_id, round(sem, 6) + CAST(0.0 AS DOUBLE) AS sem FROM sem"
    q["analyze_corpus"] = with_rec(*CORPUS) + "SELECT * FROM ranked"
    q["corpus_top10"] = with_rec(*CORPUS) + "SELECT * FROM ranked WHERE rank <= 10"
    q["prepared_top10"] = q["corpus_top10"]
    q["appended_top10"] = q["corpus_top10"]
    q["similar_fragments"] = with_rec(*PAIRS) + \
        ("SELECT a_id AS item_id, b_id AS doc_id, a_chunk, b_chunk, hit_rank, round(cosine, 6) + CAST(0.0 AS DOUBLE) AS cosine FROM f1")
    q["top_fragments"] = with_rec(*PAIRS, *_top("round(cosine, 3)")) + \
        "SELECT a_id AS item_id, b_id AS doc_id, frag_rank, a_chunk, b_chunk, score FROM ft"
    q["rerank_fragments"] = with_rec(*PAIRS, *_top(_jacc_score())) + \
        "SELECT a_id AS item_id, b_id AS doc_id, frag_rank, a_chunk, b_chunk, score FROM ft"
    q["analyze_pairs"] = with_rec(
        *PAIRS, *_top("round(cosine, 3)"),
        token_cte("qtok", "qp"), token_cte("dtok", "dp"), sig_cte("qsig", "qtok"), sig_cte("dsig", "dtok"),
        hash_emb_cte("qde", "(SELECT item_id AS uid, text AS txt FROM benchmark)", DIM),
        hash_emb_cte("dde", "(SELECT doc_id AS uid, text AS txt FROM documents)", DIM),
        "ppr AS (SELECT a_id AS l, b_id AS r FROM pairs)",
        dots_cte("pdd", "qde", "dde", pairs="ppr"),
        *ai_cte("aiq", "benchmark", "item_id"),
        """pm AS (SELECT p.a_id, p.b_id, count(*) AS matches FROM pairs p JOIN qsig a ON a.id = p.a_id
  JOIN dsig b ON b.id = p.b_id AND b.slot = a.slot AND b.val = a.val GROUP BY p.a_id, p.b_id)""",
        f"""pp AS (SELECT p.a_id, p.b_id, coalesce(l.lex, 0.0) AS lex,
  CASE WHEN p.a_id NOT IN (SELECT id FROM qsig) AND p.b_id NOT IN (SELECT id FROM dsig) THEN 1.0
       WHEN p.a_id NOT IN (SELECT id FROM qsig) OR p.b_id NOT IN (SELECT id FROM dsig) THEN 0.0
       ELSE coalesce(m.matches, 0) / {dbl(float(P.minhash_perms))} END AS mh,
  greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), coalesce(d.dot, 0.0))) AS sem
  FROM pairs p LEFT JOIN lx l ON l.q_id = p.a_id AND l.d_id = p.b_id
  LEFT JOIN pm m ON m.a_id = p.a_id AND m.b_id = p.b_id
  LEFT JOIN pdd d ON d.l = p.a_id AND d.r = p.b_id)""") + f"""SELECT pp.a_id AS item_id, pp.b_id AS doc_id,
  round(pp.lex, 3) AS lex_score, round(pp.mh, 3) AS minhash_score, round(pp.sem, 3) AS semantic_score,
  {_final('pp.lex', 'pp.mh', 'pp.sem')} AS final_score, {_level(_final('pp.lex', 'pp.mh', 'pp.sem'))} AS level,
  coalesce((SELECT count(*) FROM ft WHERE ft.a_id = pp.a_id AND ft.b_id = pp.b_id), 0) AS n_fragments,
  coalesce((SELECT string_agg(frag_a || '|' || frag_b, '||' ORDER BY frag_rank) FROM ft
    WHERE ft.a_id = pp.a_id AND ft.b_id = pp.b_id), '') AS fragment_texts,
  a.ai_probability, a.ai_label, a.perplexity, a.burstiness
FROM pp LEFT JOIN aiq a ON a.id = pp.a_id"""
    q["burstiness"] = (f"SELECT conv_id, turn, round({burst_of('w')}, 9) AS burstiness FROM "
                       f"(SELECT conv_id, turn, {wc_list_expr('text')} AS w FROM conversations) x")
    q["bigram_model"] = with_(*lm_ctes("conversations", "conv_id")[:2]) + "SELECT w1, w2, c12 FROM lm_pairs"
    q["perplexity"] = with_(*lm_ctes("conversations", MSG)) + \
        "SELECT id.i AS conv_id, id.t AS turn, round(perplexity, 6) AS perplexity FROM ppl"
    q["ai_probability"] = with_(*ai_cte("ai", "conversations", MSG)) + \
        "SELECT id.i AS conv_id, id.t AS turn, perplexity, burstiness, ai_probability, ai_label FROM ai"
    q["corpus_counts"] = "SELECT source, lang, count(*) AS n_docs FROM documents GROUP BY source, lang"
    q["corpus_catalog"] = "SELECT source, max(source || '/' || lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS path FROM documents GROUP BY source"
    # Stripped texts, of .docx files without blank lines; empty ones are no documents
    pages = r"""WITH files AS (
  SELECT lpad(CAST(page_id AS VARCHAR), 12, '0') AS name, page_id % 2 = 0 AS even, coalesce(html, '') AS html FROM pages),
 texts AS (
  SELECT name, CASE WHEN even THEN '.txt' ELSE '.docx' END AS suffix, regexp_replace(CASE WHEN even THEN html ELSE
         array_to_string(list_filter(string_split(html, chr(10)), lambda y: regexp_replace(y, '@', '', 'g') <> ''), chr(10)) END, '@', '', 'g') AS text
  FROM files) """.replace("@", T.STRIP_RE)
    q["folder_corpus"] = pages + """
SELECT name, suffix, length(text) AS n_chars, md5(text) AS text_md5, CAST(NULL AS VARCHAR) AS error FROM texts WHERE text <> ''
UNION ALL
SELECT lpad(CAST(page_id AS VARCHAR), 12, '0'), '.pdf', NULL, NULL, 'no PDF extractor configured' FROM pages WHERE page_id % 7 = 0"""
    q["folder_counts"] = pages + "SELECT suffix, count(*) AS n_docs FROM texts WHERE text <> '' GROUP BY suffix"
    cached = "sha256(text) IN (SELECT sha256(text) FROM documents WHERE lang = 'en')"
    q["cache_hits"] = f"SELECT doc_id, sha256(text) AS text_sha256, CAST({DIM} AS BIGINT) AS dims FROM documents WHERE {cached}"
    q["cache_misses"] = f"SELECT DISTINCT sha256(text) AS text_sha256, length(text) AS n_chars FROM documents WHERE NOT {cached}"
    q["embed_with_cache"] = with_rec(*CHUNKS_D, CHUNK_EMB[1]) + """SELECT c.id AS doc_id, c.chunk_no, sha256(c.chunk) AS text_sha256,
  coalesce(e.n, 0) AS n_nonzero FROM dch c LEFT JOIN (SELECT uid, count(*) AS n FROM dce GROUP BY uid) e
  ON e.uid.i = c.id AND e.uid.c = c.chunk_no"""
    return q
