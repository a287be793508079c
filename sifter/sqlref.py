"""SQL forms of the operators, for the DuckDB oracle of ``__spark_entry__.oracle_sql``.

These strings restate each operator's definition in plain SQL over the driver's
tables so that an independent engine can check the Spark plans. They are never
executed by the library itself.
"""

from __future__ import annotations

from sifter.functions import hashing
from sifter.functions import text as T
from sifter.operators.lexical import UNSHARED_IDF_SQ
from sifter.params import DEFAULT, Params


def s(x: str) -> str:
    """SQL string literal."""
    return "'" + x.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def lemma_case(t: str, rules=T.LEMMA_RULES) -> str:
    whens = " ".join(
        f"WHEN ends_with({t}, {s(suf)}) AND length({t}) >= {n}"
        + (f" AND regexp_matches({t}, {s(extra)})" if extra else "")
        + f" THEN left({t}, length({t}) - {len(suf)}) || {s(rep)}"
        for suf, n, extra, rep in rules)
    return f"(CASE {whens} ELSE {t} END)"


def lemmas_expr(text: str, p: Params = DEFAULT) -> str:
    stop = "[" + ", ".join(s(w) for w in p.stopwords) + "]"
    norm = f"regexp_replace(lower({text}), {s(T.NOT_KEPT_RE)}, '', 'g')"
    toks = (f"list_transform(regexp_extract_all({norm}, {s(T.TOKEN_RE)}), "
            f"lambda t: regexp_replace(t, {s(T.CLITIC_RE)}, '', 'g'))")
    kept = (f"list_filter({toks}, lambda t: length(t) >= {p.min_token_chars} "
            f"AND NOT list_contains({stop}, t))")
    return f"list_transform({kept}, lambda t: {lemma_case('t')})"


def processed_expr(text: str, p: Params = DEFAULT) -> str:
    return f"array_to_string({lemmas_expr(text, p)}, ' ')"


def normalize_expr(text: str) -> str:
    return f"regexp_replace(lower({text}), {s(T.NOT_KEPT_RE)}, '', 'g')"


def strip_expr(x: str) -> str:
    return f"regexp_replace({x}, {s(T.STRIP_RE)}, '', 'g')"


def word_count_expr(x: str) -> str:
    return f"len(regexp_extract_all({x}, {s(T.WORD_RE)}))"


def sentences_expr(text: str) -> str:
    marked = f"regexp_replace({text}, {s(T.SENT_END_RE)}, '\\1' || chr(10), 'g')"
    parts = f"string_split_regex({marked}, '\\n+')"
    return f"list_filter(list_transform({parts}, lambda x: {strip_expr('x')}), lambda x: x <> '')"


def ngrams_expr(toks: str) -> str:
    bi = f"list_transform(range(1, len({toks})), lambda i: {toks}[i] || ' ' || {toks}[i + 1])"
    tri = (f"list_transform(range(1, len({toks}) - 1), "
           f"lambda i: {toks}[i] || ' ' || {toks}[i + 1] || ' ' || {toks}[i + 2])")
    return f"list_concat(list_concat({toks}, {bi}), {tri})"


def processed_cte(name: str, table: str, id_col: str, p: Params = DEFAULT) -> str:
    return f"{name} AS (SELECT {id_col} AS id, {processed_expr('text', p)} AS processed FROM {table})"


def tf_cte(name: str, proc: str) -> str:
    toks = f"regexp_extract_all(processed, {s(T.TFIDF_TOKEN_RE)})"
    return (f"{name} AS (SELECT id, term, count(*) AS tf FROM "
            f"(SELECT id, unnest({ngrams_expr('toks')}) AS term FROM "
            f"(SELECT id, {toks} AS toks FROM {proc}) t0) g GROUP BY id, term)")


def tfidf_cte(name: str, qtf: str, dtf: str) -> str:
    """(q_id, d_id, lex) for pairs sharing a term."""
    k = dbl(UNSHARED_IDF_SQ)
    return f"""{name} AS (
  SELECT sh.q_id, sh.d_id,
         least(CAST(1.0 AS DOUBLE), CAST(sh.dot AS DOUBLE) / sqrt(
           (CAST(sh.qs AS DOUBLE) + {k} * (CAST(qt.qt AS DOUBLE) - CAST(sh.qs AS DOUBLE)))
         * (CAST(sh.ds AS DOUBLE) + {k} * (CAST(dt.dt AS DOUBLE) - CAST(sh.ds AS DOUBLE))))) AS lex
  FROM (SELECT q.id AS q_id, d.id AS d_id, sum(q.tf * d.tf) AS dot, sum(q.tf * q.tf) AS qs,
               sum(d.tf * d.tf) AS ds
        FROM {qtf} q JOIN {dtf} d ON q.term = d.term GROUP BY q.id, d.id) sh
  JOIN (SELECT id, sum(tf * tf) AS qt FROM {qtf} GROUP BY id) qt ON qt.id = sh.q_id
  JOIN (SELECT id, sum(tf * tf) AS dt FROM {dtf} GROUP BY id) dt ON dt.id = sh.d_id)"""


def token_cte(name: str, proc: str) -> str:
    return (f"{name} AS (SELECT DISTINCT id, token FROM (SELECT id, unnest(regexp_extract_all(processed, "
            f"{s(T.WORD_RE)})) AS token FROM {proc}) x)")


def sig_cte(name: str, tokens: str, p: Params = DEFAULT) -> str:
    """(id, slot, val) MinHash signature in long form."""
    coeffs = hashing.minhash_coefficients(p.minhash_perms, p.minhash_seed)
    values = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(coeffs))
    h = "CAST(('0x' || substr(md5(token), 1, 7)) AS BIGINT)"
    return f"""{name} AS (
  SELECT t.id, c.slot, min((c.a * t.h + c.b) % {hashing.MERSENNE_31}) AS val
  FROM (SELECT id, {h} AS h FROM {tokens}) t
  CROSS JOIN (VALUES {values}) c(slot, a, b)
  GROUP BY t.id, c.slot)"""


def mh_cte(name: str, qsig: str, dsig: str, p: Params = DEFAULT) -> str:
    return (f"{name} AS (SELECT q.id AS q_id, d.id AS d_id, count(*) AS matches, "
            f"count(*) / {dbl(float(p.minhash_perms))} AS mh FROM {qsig} q JOIN {dsig} d "
            f"ON q.slot = d.slot AND q.val = d.val GROUP BY q.id, d.id)")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def with_rec(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def sents_cte(name: str, table: str, id_col: str) -> str:
    """(id, i, sent, wc, c_incl): sentences from 0 with running word totals."""
    return f"""{name} AS (
  SELECT id, i, sent, wc, sum(wc) OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS c_incl
  FROM (SELECT id, CAST(i AS INTEGER) AS i, sent, CAST({word_count_expr('sent')} AS INTEGER) AS wc
        FROM (SELECT id, unnest(generate_series(0, len(ss) - 1)) AS i, unnest(ss) AS sent
              FROM (SELECT {id_col} AS id, {sentences_expr('text')} AS ss FROM {table}) s0) s1) s2)"""


def chunks_cte(name: str, sents: str, table: str, id_col: str, p: Params = DEFAULT) -> str:
    """(id, chunk_no, first_sent, last_sent, n_words, chunk) by a recursive walk over sentences.

    State after sentence i is the start ``st`` of the open chunk. Sentence i+1 closes it
    when the words of st..i+1 exceed the maximum; the new start is the later of st and
    the first sentence p with words(p..i) <= overlap."""
    mx, ov = p.chunk_max_words, p.chunk_overlap_words
    grow = f"nx.c_incl - (cs.c_incl - cs.wc) > {mx}"
    return f"""ov_{name} AS (
  SELECT a.id, a.i, min(b.i) AS ovs FROM {sents} a JOIN {sents} b
    ON a.id = b.id AND b.i <= a.i AND (a.c_incl - a.wc) - (b.c_incl - b.wc) <= {ov}
  GROUP BY a.id, a.i),
walk_{name} AS (
  SELECT id, i, i AS st, CAST(NULL AS INTEGER) AS es, CAST(NULL AS INTEGER) AS ee FROM {sents} WHERE i = 0
  UNION ALL
  SELECT w.id, w.i + 1,
         CASE WHEN {grow} THEN greatest(w.st, o.ovs) ELSE w.st END,
         CASE WHEN {grow} THEN w.st END,
         CASE WHEN {grow} THEN w.i END
  FROM walk_{name} w
  JOIN {sents} nx ON nx.id = w.id AND nx.i = w.i + 1
  JOIN {sents} cs ON cs.id = w.id AND cs.i = w.st
  JOIN ov_{name} o ON o.id = w.id AND o.i = w.i + 1),
bounds_{name} AS (
  SELECT id, es AS s, ee AS e FROM walk_{name} WHERE es IS NOT NULL
  UNION ALL
  SELECT w.id, w.st, w.i FROM walk_{name} w
  JOIN (SELECT id, max(i) AS last FROM {sents} GROUP BY id) l ON l.id = w.id AND w.i = l.last),
{name} AS (
  SELECT b.id, CAST(row_number() OVER (PARTITION BY b.id ORDER BY b.e) - 1 AS INTEGER) AS chunk_no,
         CAST(b.s AS INTEGER) AS first_sent, CAST(b.e AS INTEGER) AS last_sent,
         CAST(sum(x.wc) AS INTEGER) AS n_words, string_agg(x.sent, ' ' ORDER BY x.i) AS chunk
  FROM bounds_{name} b JOIN {sents} x ON x.id = b.id AND x.i BETWEEN b.s AND b.e
  GROUP BY b.id, b.s, b.e
  UNION ALL
  SELECT {id_col}, 0, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST({word_count_expr('text')} AS INTEGER), text
  FROM {table} WHERE {id_col} NOT IN (SELECT id FROM {sents}))"""


def hash_emb_cte(name: str, src: str, dim: int) -> str:
    """Sparse hashing-encoder vectors (uid, bucket, cnt, weight FLOAT) of ``src (uid, txt)``."""
    return f"""{name}_c AS (
  SELECT uid, bucket, sum(sg) AS cnt FROM (
    SELECT uid, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % {dim} AS bucket,
           CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END AS sg
    FROM (SELECT uid, md5(unnest(regexp_extract_all(lower(txt), {s(T.VECTOR_TOKEN_RE)}))) AS h FROM {src}) z) y
  GROUP BY uid, bucket HAVING sum(sg) <> 0),
{name} AS (
  SELECT c.uid, c.bucket, c.cnt, CAST(CAST(c.cnt AS DOUBLE) / sqrt(CAST(n.sq AS DOUBLE)) AS FLOAT) AS weight
  FROM {name}_c c JOIN (SELECT uid, sum(cnt * cnt) AS sq FROM {name}_c GROUP BY uid) n ON n.uid = c.uid)"""


def dots_cte(name: str, a: str, b: str, pairs: str | None = None) -> str:
    """(l, r, dot) for sparse vectors sharing a bucket (optionally only pairs (l, r) listed)."""
    if pairs is None:
        return (f"{name} AS (SELECT a.uid AS l, b.uid AS r, sum(CAST(a.weight AS DOUBLE) * CAST(b.weight AS DOUBLE)) AS dot "
                f"FROM {a} a JOIN {b} b ON a.bucket = b.bucket GROUP BY a.uid, b.uid)")
    return (f"{name} AS (SELECT pr.l, pr.r, sum(CAST(a.weight AS DOUBLE) * CAST(b.weight AS DOUBLE)) AS dot "
            f"FROM {pairs} pr JOIN {a} a ON a.uid = pr.l JOIN {b} b ON b.uid = pr.r AND b.bucket = a.bucket "
            f"GROUP BY pr.l, pr.r)")


def lm_ctes(texts: str, id_expr: str, p: Params = DEFAULT) -> list[str]:
    """Bigram model on documents with labels.quality = 1 and (id, ppl) for ``texts``."""
    tok = f"regexp_extract_all(lower(text), {s(T.VECTOR_TOKEN_RE)})"
    return [
        f"tr AS (SELECT {tok} AS t FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))",
        "lm_pairs AS (SELECT w1, w2, count(*) AS c12 FROM (SELECT unnest(t[1:len(t) - 1]) AS w1, "
        "unnest(t[2:len(t)]) AS w2 FROM tr) x GROUP BY w1, w2)",
        "lm_ctx AS (SELECT w1, sum(c12) AS c1 FROM lm_pairs GROUP BY w1)",
        "lm_v AS (SELECT count(DISTINCT w) + 1 AS v FROM (SELECT unnest(t) AS w FROM tr) x)",
        f"lt AS (SELECT {id_expr} AS id, {tok} AS t FROM {texts})",
        "bg AS (SELECT id, w1, w2, count(*) AS n FROM (SELECT id, unnest(t[1:len(t) - 1]) AS w1, "
        "unnest(t[2:len(t)]) AS w2 FROM lt) x GROUP BY id, w1, w2)",
        f"""ppl AS (SELECT lt.id, exp(-(s.sl / s.sn)) AS perplexity FROM lt LEFT JOIN (
  SELECT bg.id, sum(bg.n * ln((CAST(coalesce(pp.c12, 0) AS DOUBLE) + {dbl(p.lm_add_k)})
                  / (CAST(coalesce(cx.c1, 0) AS DOUBLE) + {dbl(p.lm_add_k)} * CAST(lm_v.v AS DOUBLE)))) AS sl,
         sum(bg.n) AS sn
  FROM bg LEFT JOIN lm_pairs pp ON pp.w1 = bg.w1 AND pp.w2 = bg.w2
  LEFT JOIN lm_ctx cx ON cx.w1 = bg.w1 CROSS JOIN lm_v GROUP BY bg.id) s ON s.id = lt.id)""",
    ]


def wc_list_expr(text: str) -> str:
    return f"list_transform({sentences_expr(text)}, lambda x: CAST({word_count_expr('x')} AS DOUBLE))"


def burst_of(w: str) -> str:
    """Burstiness of a DOUBLE list column ``w`` of sentence word counts."""
    mean = f"(list_sum({w}) / len({w}))"
    return (f"(CASE WHEN len({w}) < 2 THEN CAST(0.0 AS DOUBLE) ELSE "
            f"sqrt(list_sum(list_transform({w}, lambda x: (x - {mean}) * (x - {mean}))) / len({w})) "
            f"/ ({mean} + CAST(1e-9 AS DOUBLE)) END)")


def ai_cte(name: str, texts: str, id_expr: str, p: Params = DEFAULT) -> list[str]:
    """(id, perplexity, burstiness, ai_probability, ai_label) for ``texts``."""
    ai, human = p.ai_labels
    raw = (f"(CASE WHEN pp.perplexity IS NULL THEN NULL ELSE greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), "
           f"(CAST(1.0 AS DOUBLE) - pp.perplexity / {dbl(p.ai_ppl_scale)}) * CAST(0.6 AS DOUBLE) "
           f"+ (CAST(1.0 AS DOUBLE) - b.b) * CAST(0.4 AS DOUBLE))) END)")
    return lm_ctes(texts, id_expr, p) + [
        f"bu0 AS (SELECT {id_expr} AS id, {wc_list_expr('text')} AS w FROM {texts})",
        f"bu AS (SELECT id, {burst_of('w')} AS b FROM bu0)",
        f"""{name} AS (SELECT b.id, round(pp.perplexity, 1) AS perplexity, round(b.b, 3) AS burstiness,
  round({raw}, 3) AS ai_probability,
  CASE WHEN {raw} IS NULL THEN NULL WHEN {raw} > {dbl(p.ai_threshold)} THEN {s(ai)} ELSE {s(human)} END AS ai_label
  FROM bu b LEFT JOIN ppl pp ON pp.id = b.id)""",
    ]
