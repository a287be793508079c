"""Personal data by weak supervision, in DataFrame functions only.

Base rules (regular expressions with checks) give spans that always stay. Looser candidates
(digit runs, those of base spans included, and the parts of runs in which numbers may stand
side by side) get votes from labelers: the base rules, a format
pattern, a checksum, gazetteers of number prefixes and of context words, their surroundings.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is; a logistic span classifier is then
trained on the resulting soft labels and decides which candidates become spans too. Only
pattern counts, bounded by the number of patterns, reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import written

KINDS = ("email", "ip", "card", "phone")
#: The kind of spans that the classifier adds.
ADDED = "number"
THRESHOLD = 0.8
#: What a part of a run counts in the fit; parts overlap, runs count 1.
PART_WEIGHT = 0.1
#: Digits that a candidate has.
LEAST_DIGITS, MOST_DIGITS = 7, 19
#: Spans are numbered in blocks of this many, so long lists cost no square.
BLOCK = 256

# The base patterns. Possessive quantifiers and the start conditions change no match: a run
# that fails from its first character fails from every later one. They keep long runs linear.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_CANDIDATE = r"(?:\G|(?<![0-9]))\(?[0-9](?:[\x20().-]{0,3}+[0-9])++"

# The forms of single numbers.
_PHONE = r"^(?:[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}$"
_CARD = r"^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$"
_SHORT_CARD = r"^[0-9]{4}([\x20-])[0-9]{6}\1[0-9]{5}$"

# Words that announce a number in the corpus languages.
_CONTEXT = ("account", "anruf", "appel", "call", "card", "carte", "compte", "contact", "fax", "fon", "handy", "iban", "karte",
            "konto", "kontakt", "llamar", "mobil", "movil", "number", "numero", "nummer", "passport", "phone", "ssn", "tarjeta", "tel")
# Leading digits of payment card ranges.
_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    return F.call_function("luhn_check", x)


_CHECKS = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: x.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": lambda x: F.length(_digits(x)).between(16, 19) & _luhn(_digits(x)),
    "phone": lambda x: F.length(_digits(x)).between(8, 15),
}
#: Cheap conditions without which a pattern cannot match.
_MAY = {
    "email": lambda t: t.contains("@"), "ip": lambda t: t.contains("."), "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: t.contains("+"), ADDED: lambda t: t.rlike(r"[0-9][\x20().-]{0,3}[0-9]"),
    "digits": lambda t: t.rlike(r"[0-9][\x20().-]{1,3}[0-9]"),
}


def _starts(gaps: str, found: str) -> str:
    """SQL: the start (code points) of each match, from the matches and the text between them."""
    sizes = f"transform({found}, (x, i) -> cast(length({gaps}[i]) + length(x) as bigint))"
    blocks = (f"if(size({found}) < {BLOCK}, array(0L), aggregate(sequence(1, size({found}) div {BLOCK}), array(0L), (a, b) -> concat(a, array("
              f"a[cast(b - 1 as int)] + aggregate(slice(s.z, cast((b - 1) * {BLOCK} + 1 as int), {BLOCK}), 0L, (p, y) -> p + y)))))")
    # the sizes and block sums are bound once by transforming one-element arrays
    return (f"flatten(transform(array(struct({sizes} as z)), s -> flatten(transform(array(struct({blocks} as b)), t -> "
            f"transform({found}, (x, i) -> t.b[i div {BLOCK}] + aggregate(slice(s.z, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK}), 0L, (p, y) -> p + y)"
            f" + length({gaps}[i]))))))")


def _matches(df: DataFrame, kind: str, pattern: str) -> DataFrame:
    """Adds __m_<kind>, the matches, and __g_<kind>, the text around them."""
    empty = F.array().cast("array<string>")
    may = _MAY[kind](F.col("__text"))
    return (df.withColumn(f"__m_{kind}", F.when(may, F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))).otherwise(empty))
            .withColumn(f"__g_{kind}", F.when(F.size(f"__m_{kind}") > 0, F.split("__text", pattern, -1)).otherwise(empty)))


def _spans(df: DataFrame, kind: str) -> DataFrame:
    """Adds __<kind>: array<struct<start, stop, ok, text, before, after>>."""
    found, gaps = f"__m_{kind}", f"__g_{kind}"
    df = df.withColumn("__s", F.expr(f"if(size({found}) = 0, cast(array() as array<bigint>), {_starts(gaps, found)})"))
    check = _CHECKS.get(kind, lambda x: F.length(_digits(x)).between(LEAST_DIGITS, MOST_DIGITS))
    spans = F.transform(found, lambda x, i: F.struct(
        F.col("__s")[i].alias("start"), (F.col("__s")[i] + F.length(x)).alias("stop"), x.alias("text"),
        F.lower(F.right(F.col(gaps)[i], F.lit(30))).alias("before"), F.substring(F.col(gaps)[i + 1], 1, 1).alias("after")))
    return df.withColumn(f"__{kind}", F.filter(spans, lambda s: check(s["text"]))).drop("__s", found, gaps)


def _parts(df: DataFrame) -> DataFrame:
    """Adds __parts, like the columns of ``_spans``: strings of neighbouring digit groups of a run
    but the run itself, with LEAST_DIGITS to MOST_DIGITS digits, none in a base span. They are
    single groups, what stands between blanks, what has the form of a phone or card number, and
    what base spans leave of a run. A plus before one counts as its own. Digit groups are
    numbered once, so long lists cost no square."""
    df = _matches(df, "digits", "[0-9]++")
    df = df.withColumn("__s", F.expr(f"if(size(__m_digits) = 0, cast(array() as array<bigint>), {_starts('__g_digits', '__m_digits')})"))
    # the last element has only the text after the last group
    df = df.withColumn("__d", F.expr("""transform(__g_digits, (g, i) -> struct(
        g as gap, i > 0 and i < size(__m_digits) and length(g) <= 3 and not g rlike '[^ ().-]' as link,
        if(i < size(__m_digits), __m_digits[i], '') as text, if(i < size(__m_digits), __s[i], 0L) as start,
        i < size(__m_digits) and not exists(pii_base, b -> b.start < __s[i] + length(__m_digits[i]) and b.stop > __s[i]) as free))"""))
    parts = F.expr(f"""flatten(transform(__d, (x, i) -> if(not x.free or not (x.link or __d[i + 1].link),
        cast(array() as array<struct<start: bigint, stop: bigint, text: string, before: string, after: string, alone: boolean>>),
        transform(filter(sequence(1, least({MOST_DIGITS}, size(__d) - 1 - i)), k -> (x.link or __d[i + k].link)
                and forall(slice(__d, i + 2, k - 1), y -> y.link and y.free)
                and aggregate(slice(__d, i + 1, k), 0, (n, y) -> n + length(y.text)) between {LEAST_DIGITS} and {MOST_DIGITS}),
            k -> struct(if(x.gap like '%(', x.start - 1, x.start) as start, __d[i + k - 1].start + length(__d[i + k - 1].text) as stop,
                concat(if(x.gap like '%(', '(', ''), x.text, array_join(transform(slice(__d, i + 2, k - 1), y -> concat(y.gap, y.text)), '')) as text,
                lower(right(regexp_replace(x.gap, '[+]?[(]?$', ''), 30)) as before, substring(__d[i + k].gap, 1, 1) as after,
                k = 1 or (not x.link or not __d[i - 1].free) and (not __d[i + k].link or not __d[i + k].free)
                or (not x.link or x.gap like '% %') and (not __d[i + k].link or __d[i + k].gap like '% %')
                    and forall(slice(__d, i + 2, k - 1), y -> not y.gap like '% %') as alone)))))""")
    formed = F.filter(parts, lambda c: c["alone"] | c["text"].rlike(_PHONE) | c["text"].rlike(_CARD) | c["text"].rlike(_SHORT_CARD))
    return df.withColumn("__parts", formed).drop("__s", "__d", "__m_digits", "__g_digits")


def _named(spans: str | Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _labelled(c: Column, part: bool) -> Column:
    """A candidate with the labelers' votes (1, -1, 0: abstains) and the classifier's features;
    ``free`` when no base span overlaps it; ``part``: not a run but a part of one."""
    free = ~F.exists("pii_base", lambda s: (s["start"] < c["stop"]) & (s["stop"] > c["start"]))
    digits = _digits(c["text"])
    n = F.length(digits)
    last = F.right(c["before"], F.lit(1))
    phone, grouped = c["text"].rlike(_PHONE), c["text"].rlike(_CARD)
    solid = c["text"].rlike(r"^[0-9]+$")
    apart = last.rlike(r"^[\s(\[\"'=:,;]?$") & c["after"].rlike(r"^[\s)\]\"',;:.!?]?$")
    same = digits.rlike(r"^([0-9])\1+$")
    dated = c["text"].rlike(r"^(?:19|20)[0-9]{2}[\x20.-](?:0?[1-9]|1[0-2])[\x20.-][0-9]{1,2}$")
    words = c["before"].rlike(r"(?:" + "|".join(_CONTEXT) + r")[^0-9]{0,12}$")
    card = n.between(13, 19)
    return F.struct(
        c["start"].alias("start"), c["stop"].alias("stop"), free.alias("free"), F.lit(part).alias("part"), n.alias("digits"),
        F.array(_vote(~free, F.lit(False)), _vote(phone | grouped, dated | same), _vote(card & _luhn(digits), card),
                _vote(card & digits.rlike(_ISSUERS), n < 8), _vote(words, F.lit(False)), _vote(apart, ~apart)).alias("votes"),
        F.array(*[x.cast("int") for x in (phone, grouped, solid, card, n.between(9, 12), apart, same | dated, _luhn(digits), words)]).alias("features"))


LABELERS, FEATURES = 6, 9


def annotate(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``pii_base`` (array of kind, start, stop; by kind as listed, then start) and
    ``pii_candidates`` (digit runs and their parts with votes and features). Null counts as empty."""
    kept = df.columns
    df = df.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    for kind, pattern in [*_BASE.items(), (ADDED, _CANDIDATE)]:
        df = _matches(df, kind, pattern)
    for kind in (*KINDS, ADDED):
        df = _spans(df, kind)
    df = df.withColumn("pii_base", F.concat(*[_named(f"__{kind}", kind) for kind in KINDS]))
    runs, parts = (F.transform(f"__{name}", lambda c: _labelled(c, part)) for name, part in ((ADDED, False), ("parts", True)))
    return _parts(df).withColumn("pii_candidates", F.concat(runs, parts)).select(*kept, "pii_base", "pii_candidates")


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over distinct vote rows: P(personal | votes) of each row and
    P(vote | class) as [class, labeler, vote + 1]."""
    share = np.clip(0.5 + 0.2 * votes.sum(axis=1), 0.05, 0.95)  # start: the labelers' majority
    for _ in range(rounds):
        weight = np.stack((1 - share, share)) * counts
        prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        table = np.stack([[[(w * (votes[:, j] == v)).sum() + 1 for v in (-1, 0, 1)] for j in range(votes.shape[1])] for w in weight])
        table /= table.sum(axis=2, keepdims=True)
        log = np.log(prior)[:, None] + np.stack([sum(np.log(t[j, votes[:, j] + 1]) for j in range(votes.shape[1])) for t in table])
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - share).max(initial=0) < 1e-9:
            break
        share = new
    return share, table


def train_spans(features: np.ndarray, share: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (the last is the bias) of a logistic classifier on soft labels, by Newton steps."""
    x = np.column_stack((features, np.ones(len(features)))).astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (p - share)) + ridge * w
        step = np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(annotated: DataFrame) -> list[float]:
    """The span classifier's weights, from the counts of (votes, features) over all candidates
    (at most 2 * 3**LABELERS * 2**FEATURES rows). Runs and parts count with fixed weights at
    every size of the table. Without candidates nothing will be added."""
    # a plain explode would make the optimizer work the candidates out twice
    rows = (annotated.select(F.explode_outer("pii_candidates").alias("c")).where("c is not null").groupBy("c.votes", "c.features", "c.part").agg(F.count(F.lit(1)).alias("n"))
            .collect())
    if not rows:
        return [0.0] * FEATURES + [-30.0]
    rows = sorted((r[0], r[1], r[3] * (PART_WEIGHT if r[2] else 1.0)) for r in rows)
    votes, features, counts = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
    share, _ = reliabilities(votes, counts)
    return train_spans(features, share, counts).tolist()


#: SQL: the spans of __ends (stop, start, gain; by stop) that are apart and have the most gain. Each
#: step adds the best total up to its stop and the step it builds on; at most the square of
#: MOST_DIGITS parts end inside a part, so only so many steps are looked at.
_BEST = f"""aggregate(reverse(aggregate(__ends, array(named_struct('start', 0L, 'stop', 0L, 'total', 0D, 'back', 0, 'own', false)), (a, c) -> concat(a, transform(
    transform(array(size(a) - size(filter(slice(a, greatest(1, size(a) - {MOST_DIGITS**2}), {MOST_DIGITS**2 + 1}), y -> y.stop > c.start))), p -> struct(p as p, a[p - 1].total + c.gain as total)),
    t -> if(t.total > a[size(a) - 1].total, named_struct('start', c.start, 'stop', c.stop, 'total', t.total, 'back', t.p, 'own', true),
        named_struct('start', c.start, 'stop', c.stop, 'total', a[size(a) - 1].total, 'back', size(a), 'own', false)))))),
    named_struct('at', size(__ends) + 1, 'now', size(__ends) + 1, 'out', cast(array() as array<struct<start: bigint, stop: bigint>>)),
    (s, y) -> if(s.now <> s.at, named_struct('at', s.at, 'now', s.now - 1, 'out', s.out), named_struct('at', y.back, 'now', s.now - 1,
        'out', if(y.own, concat(s.out, array(struct(y.start as start, y.stop as stop))), s.out))), s -> s.out)"""


def decide(annotated: DataFrame, weights: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """Replaces ``pii_candidates`` by ``pii_spans``: the base spans, then the free candidates
    whose probability exceeds ``threshold``, by start. Runs come before parts; of the parts that
    overlap, those stay apart from one another that have the most digits, each times its probability."""
    bar = float(np.log(threshold / (1 - threshold)))

    def score(c: Column) -> Column:
        return sum((c["features"][k] * F.lit(w) for k, w in enumerate(weights[:-1])), F.lit(weights[-1]))

    def apart(spans: Column, c: Column) -> Column:
        return ~F.exists(spans, lambda s: (s["start"] < c["stop"]) & (s["stop"] > c["start"]))

    def bounds(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["stop"].alias("stop"))

    found = annotated.withColumn("__sure", F.filter("pii_candidates", lambda c: c["free"] & (score(c) > bar)))
    found = found.withColumn("__runs", F.transform(F.filter("__sure", lambda c: ~c["part"]), bounds))
    parts = F.filter("__sure", lambda c: c["part"] & apart(F.col("__runs"), c))
    ends = F.transform(parts, lambda c: F.struct(c["stop"].alias("stop"), c["start"].alias("start"), (c["digits"] / (1 + F.exp(-score(c)))).alias("gain")))
    found = found.withColumn("__ends", F.array_sort(ends)).withColumn("__kept", F.expr(_BEST))
    added = _named(F.array_sort(F.concat("__runs", "__kept")), ADDED)
    return found.withColumn("pii_spans", F.concat("pii_base", added)).drop("pii_candidates", "__sure", "__runs", "__ends", "__kept")


def joined(spans: str) -> Column:
    """kind:start:stop of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span in ``text`` replaced by its kind in brackets; texts without
    spans, and nulls, stay as they are. All other columns are kept."""
    kept = df.columns
    df = annotate(df, text)
    # stored with both columns: a plan that needs the candidates alone would work the base
    # spans out again for every candidate
    weights = fit(written(df.select("pii_base", "pii_candidates"), "pii"))
    df = decide(df, weights).withColumn("__order", F.array_sort(F.transform("pii_spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))))
    name = "`" + text.replace("`", "``") + "`"
    clean = F.expr(f"""aggregate(__order, named_struct('at', 0L, 'out', array('')), (a, s) -> if(s.stop <= a.at, a, named_struct(
        'at', s.stop, 'out', concat(a.out, array(substring({name}, cast(a.at + 1 as int), cast(greatest(s.start - a.at, 0L) as int)), concat('[', upper(s.kind), ']'))))),
        a -> concat(array_join(a.out, ''), substring({name}, cast(a.at + 1 as int))))""")
    return df.withColumn(text, F.when(F.size("__order") > 0, clean).otherwise(F.col(text))).select(*kept)
