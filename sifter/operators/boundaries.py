"""Sentences by learned boundaries (T8): unsupervised abbreviation and starter statistics.

The rule splitter ends a sentence at every full stop before whitespace. Here the
corpus itself tells which words carry a stop as part of their spelling (after
Kiss and Strunk's published method): two grouped aggregates give log-likelihood
ratios, and the pieces of the rule splitter are put together again after an
abbreviation or an initial, unless the next word is a frequent sentence starter.

All of it is native. Words are counted as they are written before any of them is
read closely, so that the closer expressions run once a distinct word. The two learned
lists are short: they become literal sets, and every document is split and put together
again within its own row; no text is shuffled. Lists of more than ``LIST_WORDS`` words are
joined (broadcast behind a check of their size), and a document's pieces then meet in a
window on its id. NULL and blank texts have no sentence; repeated texts count each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.functions import text as T
from sifter.operators.common import bounded_broadcast, materialize
from sifter.params import Params

WORD = r"\p{L}+(?:\.\p{L}+)*"
TOKEN_RE = rf"""^[("'\[]*({WORD})(\.?)[,;:)"'\]]*$"""
LAST_RE = rf"""(?:^|[("'\[{T.WS}])({WORD})\.$"""
FIRST_RE = r"""^[("'\[]*(\p{L}+)"""
INITIAL_RE = r"^\p{Lu}$"
CAPITAL_RE = r"^\p{Lu}"
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())  # the characters of ``T.WS``

# Fixed values of the published method.
STOP_SHARE = 0.99  # share of an abbreviation's occurrences that carry a stop
ABBREVIATION_SCORE = 0.3
STARTER_RATIO = 30.0

LIST_WORDS = 50_000  # words of a learned list that become a literal set (8 s to build at most); longer lists are joined


def _likelihood(k: Column, n: Column, p: Column) -> Column:
    """Log-likelihood of ``k`` successes in ``n`` draws; 0 ln 0 is 0."""
    return F.when(k > 0, k * F.ln(p)).otherwise(0.0) + F.when(n > k, (n - k) * F.ln(1 - p)).otherwise(0.0)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n, k)``: occurrences of each lower-cased word, and those with a full stop."""
    runs = docs.select(F.explode_outer(F.split("text", " ")).alias("run")).groupBy("run").agg(F.count(F.lit(1)).alias("_n"))
    tokens = runs.select(F.explode_outer(F.split("run", f"[{T.WS}]+")).alias("token"), "_n")
    return (tokens.select(F.lower(F.regexp_extract("token", TOKEN_RE, 1)).alias("word"),
                          F.regexp_extract("token", TOKEN_RE, 2).alias("stop"), "_n")
            .where(F.col("word") != "").groupBy("word")
            .agg(F.sum("_n").alias("n"), F.sum(F.when(F.col("stop") == ".", F.col("_n")).otherwise(0)).alias("k")))


def abbreviations(counts: DataFrame) -> DataFrame:
    """``(word, n, k, score)`` of the words whose score reaches ``ABBREVIATION_SCORE``.

    The score is the log-likelihood ratio of "nearly always with a stop" against the corpus's
    share of stops, scaled down by length and by occurrences without a stop, up by inner stops. A
    short word that only ever ends sentences cannot be told from an abbreviation by it."""
    n_all, k_all = counts.agg(F.sum("n"), F.sum("k")).first()
    if not k_all:
        return counts.where(F.lit(False)).withColumn("score", F.lit(0.0))
    share = F.lit(min(k_all / n_all, 1 - 1e-9))
    letters = F.char_length(F.replace("word", F.lit("."), F.lit(""))).cast("double")
    inner = F.char_length("word") - letters
    n, k = F.col("n"), F.col("k")
    ratio = 2 * (_likelihood(k, n, F.lit(STOP_SHARE)) - _likelihood(k, n, share))
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, (k - n).cast("double"))
    return counts.where(k > 0).withColumn("score", score).where(F.col("score") >= ABBREVIATION_SCORE)


def _lines(docs: DataFrame) -> Column:
    return F.split(F.coalesce(docs["text"], F.lit("")), "\n+")


def _cut(line: Column) -> Column:
    """The rule splitter's pieces of a line; blanks can be left only at the line's own ends."""
    return F.filter(F.split(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), T.SENT_END_RE, "$1\n"), "\n"), lambda x: x != "")


def _last(piece: Column) -> Column:
    """The word before a final full stop, or an empty string; it lies behind the last space."""
    return F.when(piece.endswith("."), F.regexp_extract(F.substring_index(piece, " ", -1), LAST_RE, 1)).otherwise("")


def _pairs(cut: Column) -> Column:
    """A line's pieces, each with the next one (``following``, NULL at the end)."""
    return F.transform(cut, lambda x, i: F.struct(x.alias("text"), F.get(cut, i + 1).alias("following")))


def pieces(docs: DataFrame, id_col: str) -> DataFrame:
    """The rule splitter's pieces ``(id, line, piece, text, following, last, first, initial)``: ``last`` is the
    word before a final full stop, ``first`` the first word of the next piece of the line
    (``following``, NULL at its end)."""
    lines = docs.select(id_col, F.posexplode_outer(F.transform(F.transform(_lines(docs), _cut), _pairs)).alias("line", "_c"))
    rows = lines.select(id_col, "line", F.posexplode_outer("_c").alias("piece", "_p")).where(F.col("_p").isNotNull())
    rows = rows.select(id_col, "line", "piece", "_p.text", "_p.following", _last(F.col("_p.text")).alias("_w"))
    return rows.select(id_col, "line", "piece", "text", "following", F.lower("_w").alias("last"),
                       F.regexp_extract("following", FIRST_RE, 1).alias("first"), F.col("_w").rlike(INITIAL_RE).alias("initial"))


def _word_list(words: DataFrame) -> list[str] | None:
    """The words of a learned list, or None when it has more than ``LIST_WORDS``."""
    rows = words.select("word").limit(LIST_WORDS + 1).collect()
    return sorted(r.word for r in rows) if len(rows) <= LIST_WORDS else None


def _among(word: Column, words: list[str]) -> Column:
    return word.isin(words) if words else F.lit(False)


def _flagged(rows: DataFrame, words: DataFrame, key: str, flag: str, params: Params) -> DataFrame:
    """``rows`` with ``flag``: whether ``key`` is among ``words``."""
    side, _ = bounded_broadcast(words.select(F.col("word").alias(key), F.lit(True).alias(flag)), params.broadcast_max_rows)
    return rows.join(side, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def starters(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``(word, starts, n, ratio)``: words that follow sure boundaries (``rows`` of ``pieces`` with
    ``abbreviation``) far more often than they occur, by Dunning's ratio."""
    sure = rows.where(F.col("following").isNotNull() & ~F.col("abbreviation") & ~F.col("initial"))
    first = materialize(sure.groupBy(F.lower("first").alias("word")).agg(F.count(F.lit(1)).alias("starts")))
    total, places = counts.agg(F.sum("n")).first()[0] or 0, first.agg(F.sum("starts")).first()[0] or 0
    c, n, m, t = F.col("starts"), F.col("n"), F.lit(places), F.lit(total)
    both = first.join(counts.select("word", "n"), "word").where((c <= n) & (n < t) & (m < t) & (c * t > n * m))
    p, p1, p2 = n / t, c / m, (n - c) / (t - m)
    ratio = 2 * (_likelihood(c, m, p1) + _likelihood(n - c, t - m, p2) - _likelihood(c, m, p) - _likelihood(n - c, t - m, p))
    return both.withColumn("ratio", ratio).where(F.col("ratio") >= STARTER_RATIO).select("word", "starts", "n", "ratio")


def learned_sentences(docs: DataFrame, id_col: str, params: Params, train: DataFrame | None = None) -> DataFrame:
    """``(id, sent_no, sent)``, ``sent_no`` from 0, with boundaries learned on ``train (text)``
    (default: ``docs``); ids are unique. Pieces put together are parted by one space; a newline always ends a
    sentence. A stop after an abbreviation or a capital initial ends one only before a
    capitalised frequent starter."""
    train = docs if train is None else train
    counts = materialize(word_counts(train))
    short = materialize(abbreviations(counts).select("word"))
    known = _word_list(short)
    rows = pieces(train.withColumn("_id", F.lit(0)), "_id")
    rows = (_flagged(rows, short, "last", "abbreviation", params) if known is None
            else rows.withColumn("abbreviation", _among(F.col("last"), known)))
    first = materialize(starters(rows, counts))
    begin = _word_list(first)
    if known is None or begin is None:
        return _joined_sentences(docs, id_col, short, first, params)
    return _row_sentences(docs, id_col, known, begin)


def _row_sentences(docs: DataFrame, id_col: str, short: list[str], first: list[str]) -> DataFrame:
    """``learned_sentences`` by short lists, a document in its row: a piece is followed by a space
    where its sentence goes on and by a newline where it ends, and the whole is split at newlines."""
    def goes_on(p: Column) -> Column:
        begins = F.regexp_extract(p["following"], FIRST_RE, 1)
        return ((p["last"] != "") & p["following"].isNotNull() & (_among(F.lower(p["last"]), short) | p["last"].rlike(INITIAL_RE))
                & ~(_among(F.lower(begins), first) & begins.rlike(CAPITAL_RE)))

    def ended(cut: Column) -> Column:
        words = F.transform(_pairs(cut), lambda p: F.struct(p["text"].alias("text"), p["following"].alias("following"), _last(p["text"]).alias("last")))
        return F.array_join(F.transform(words, lambda p: F.concat(p["text"], F.when(goes_on(p), " ").otherwise("\n"))), "")

    whole = F.array_join(F.transform(F.transform(_lines(docs), _cut), ended), "")
    sents = F.filter(F.split(whole, "\n"), lambda x: x != "")
    rows = docs.select(id_col, F.posexplode_outer(sents).alias("sent_no", "sent")).where(F.col("sent").isNotNull())
    return rows.select(id_col, F.col("sent_no").cast("long").alias("sent_no"), "sent")


def _joined_sentences(docs: DataFrame, id_col: str, short: DataFrame, first: DataFrame, params: Params) -> DataFrame:
    """``learned_sentences`` by lists of any length."""
    rows = _flagged(pieces(docs, id_col), short, "last", "abbreviation", params)
    rows = _flagged(rows.withColumn("_low", F.lower("first")), first, "_low", "starter", params)
    begins = F.col("starter") & F.col("first").rlike(CAPITAL_RE)
    rows = rows.withColumn("_open", F.col("following").isNotNull() & (F.col("abbreviation") | F.col("initial")) & ~begins)
    line = Window.partitionBy(id_col).orderBy("line", "piece")
    held = F.coalesce(F.lag("_open").over(line), F.lit(False))
    rows = rows.withColumn("_new", F.when(held, 0).otherwise(1)).withColumn("sent_no", F.sum("_new").over(line) - 1)
    joined = rows.groupBy(id_col, "sent_no").agg(F.array_sort(F.collect_list(F.struct("piece", "text"))).alias("_p"))
    return joined.select(id_col, "sent_no", F.array_join("_p.text", " ").alias("sent"))
