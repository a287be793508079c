"""Text scalars (T1-T12) as native Column expressions.

Every expression here is a built-in Spark function (JVM side, no Python), and
each regular expression is written so that Java regex and RE2 (the SQL
oracle) read it the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sifter.params import Params

# Characters for which Python's ``str.isspace`` is true, spelled out so that
# Java regex (Spark) and RE2 (DuckDB) agree on what "whitespace" is.
WS = ("\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
      "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}")
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
NOT_KEPT_RE = f"[^a-z'{WS}]"  # T1: everything but a-z, apostrophe and whitespace
WORD_RE = f"[^{WS}]+"  # a maximal non-whitespace run (what str.split() yields)
STRIP_RE = f"^[{WS}]+|[{WS}]+$"
SENT_END_RE = f"([.!?])[{WS}]+"
TOKEN_RE = "[a-z']+"  # tokens of normalised text
CLITIC_RE = "^'+|'s$|'+$"  # leading quote, possessive, trailing quote
VECTOR_TOKEN_RE = "[\\p{L}\\p{N}]+"  # tokens seen by the hashing encoder / language model
TFIDF_TOKEN_RE = "[\\p{L}\\p{N}_]{2,}"  # runs of at least two word characters

# Default lemma rules: (suffix, minimum token length, extra condition regex or None,
# replacement of the suffix). The first matching rule wins; tokens matching none
# are their own lemma. The suffix test is a cheap ``endswith``; the regex runs
# only on tokens that already end with the suffix.
LEMMA_RULES: tuple[tuple[str, int, str | None, str], ...] = (
    ("ies", 5, None, "y"),
    ("sses", 5, None, "ss"),
    ("s", 4, "[^sui']s$", ""),
    ("ing", 6, "[aeiouy].*ing$", ""),
    ("ed", 5, "[aeiouy].*ed$", ""),
)


def normalize(text: Column) -> Column:
    """Lower-case, then delete every character but a-z, apostrophe and whitespace."""
    return F.regexp_replace(F.lower(text), NOT_KEPT_RE, "")


def strip(s: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace (SQL ``trim`` only removes spaces)."""
    return F.btrim(s, F.lit(WS_CHARS))


def word_count(s: Column) -> Column:
    """``len(s.split())``."""
    return F.regexp_count(s, F.lit(WORD_RE))


def raw_tokens(norm: Column) -> Column:
    """Token surface forms of normalised text (apostrophe runs trimmed, possessive cut)."""
    return F.transform(F.regexp_extract_all(norm, F.lit(TOKEN_RE), 0),
                       lambda t: F.when(F.instr(t, "'") > 0, F.regexp_replace(t, CLITIC_RE, "")).otherwise(t))


def keep_token(t: Column, params: Params) -> Column:
    """Longer than 2 characters, not a stopword, has a letter (surface form).

    After ``raw_tokens`` a non-empty token starts with a letter, so the length test
    already implies T4 (no token made of punctuation only is left)."""
    return (F.length(t) >= params.min_token_chars) & ~t.isin(list(params.stopwords))


def lemma(t: Column, rules=LEMMA_RULES) -> Column:
    """Rule lemmatiser (first matching suffix rule)."""
    out = None
    for suffix, min_len, extra_re, repl in rules:
        cond = t.endswith(suffix) & (F.length(t) >= min_len)
        if extra_re is not None:
            cond = cond & t.rlike(extra_re)
        val = F.concat(t.substr(F.lit(1), F.length(t) - len(suffix)), F.lit(repl))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return t if out is None else out.otherwise(t)


def lemmas(text: Column, params: Params, rules=LEMMA_RULES) -> Column:
    """Array of lemmas of the kept tokens, in text order."""
    kept = F.filter(raw_tokens(normalize(text)), lambda t: keep_token(t, params))
    return F.transform(kept, lambda t: lemma(t, rules))


def preprocess(text: Column, params: Params, rules=LEMMA_RULES) -> Column:
    """The space-joined lemma string."""
    return F.array_join(lemmas(text, params, rules), " ")


def tfidf_tokens(processed: Column) -> Column:
    """Tokens a default TF-IDF vectoriser sees in preprocessed text: word runs of >= 2 chars."""
    return F.regexp_extract_all(processed, F.lit(TFIDF_TOKEN_RE), 0)


def whitespace_tokens(processed: Column) -> Column:
    """Tokens as ``str.split()`` sees them (MinHash / Jaccard input)."""
    return F.regexp_extract_all(processed, F.lit(WORD_RE), 0)


def sentences(text: Column) -> Column:
    """Rule sentence splitter on raw text; stripped, blank ones dropped.

    A boundary is a run of whitespace after ``.``, ``!`` or ``?``, or any newline.
    """
    marked = F.regexp_replace(text, SENT_END_RE, "$1\n")
    parts = F.split(marked, "\n+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def content_sha256(text: Column) -> Column:
    """Hex SHA-256 of the UTF-8 text."""
    return F.sha2(text, 256)


def clamp01(x: Column) -> Column:
    """``max(0, min(1, x))``; NULL stays NULL (``greatest``/``least`` skip NULLs)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def ngrams_1_3(tokens: Column) -> Column:
    """L1: all word 1-, 2- and 3-grams of a token array, space-joined."""
    n = F.size(tokens)
    n1 = F.greatest(n - 1, F.lit(0))
    n2 = F.greatest(n - 2, F.lit(0))
    bi = F.zip_with(F.slice(tokens, 1, n1), F.slice(tokens, 2, n1),
                    lambda a, b: F.concat(a, F.lit(" "), b))
    tri = F.zip_with(F.zip_with(F.slice(tokens, 1, n2), F.slice(tokens, 2, n2),
                                lambda a, b: F.concat(a, F.lit(" "), b)),
                     F.slice(tokens, 3, n2),
                     lambda ab, c: F.concat(ab, F.lit(" "), c))
    return F.concat(tokens, bi, tri)
