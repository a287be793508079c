"""Language identification by Bayesian evidence fusion.

Text likelihoods come from byte trigram counts of all labelled rows. They are combined with
P(declared language | language), P(address suffix | language) and a prior of the host that
is smoothed towards its domain and the domain's towards the whole corpus. These tables are
grouped sums over all rows of what the text alone says.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import prepare, release, text_blocks, written
from sifter.operators.common import bounded_broadcast

BUCKETS = 1 << 16
#: Neighbouring trigrams overlap: their log-likelihoods count for this share each.
TEMPER = 0.2
ALPHA = 0.5
#: Rows' worth of trust that a domain has in the corpus, and a host in its domain.
STRENGTH = 20.0
#: Rows whose best language is less certain, or whose text has no letter, are rejected.
LEAST = 0.5
#: Languages that are told apart, the most frequent labels: 256 KB each, 128 MB in all. A rarer
#: label is no language and says nothing as declared evidence; its rows are identified all the same.
MAX_LANGUAGES = 512
#: Languages whose counts a task holds before it hands them on.
HELD_LANGUAGES = 64
#: A row is rejected when the mean log-likelihood of its trigrams lies so many standard
#: deviations below that of its best language.
FIT = 8.0
#: Evidence tables of more rows (each one number a language) are joined by a shuffle.
BROADCAST_ROWS = 50_000


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each byte trigram of all texts, where each text's begin and the last end);
    ASCII letters are lower-cased, runs of white space and digits count as one blank."""
    cut = [b" " + b" ".join(t.encode().lower().split()) + b" " for t in texts]
    ends = np.cumsum([0, *map(len, cut)])
    data = np.frombuffer(b"".join(cut) + b"  ", np.uint8).astype(np.uint32)
    data = np.where((data >= 48) & (data <= 57), np.uint32(32), data)
    code = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), ends


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)


def train(df: DataFrame, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihood [bucket, language]) from all rows with a label: each task
    adds up its trigrams before the shuffle; the table has BUCKETS rows a language."""
    prepare(df.sparkSession)
    source = df.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).cast("string").alias("lang"), F.col(text).alias("text"))
    order = [F.col("n").desc(), F.col("lang")]
    languages = sorted(r[0] for r in source.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(*order).limit(MAX_LANGUAGES).collect())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        number, counts = {x: k for k, x in enumerate(languages)}, {}

        def out() -> pa.RecordBatch:
            found = [(lang, bucket := np.flatnonzero(n), n[bucket]) for lang, n in counts.items()]
            counts.clear()
            lang = np.repeat(np.array([f[0] for f in found], np.int32), [len(f[1]) for f in found])
            bucket, n = (np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]]) for k in (1, 2))
            return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket.astype(np.int32)), pa.array(n)], ["lang", "bucket", "n"])

        for batch in batches:
            for first, texts in text_blocks(batch.column(1)):
                bucket, ends = trigrams(texts)
                langs = np.array([number.get(x, -1) for x in batch.column(0).slice(first, len(texts)).to_pylist()], np.int64)
                owner = np.repeat(langs, np.diff(ends))
                for lang in set(langs[langs >= 0].tolist()):
                    if lang not in counts:
                        if len(counts) == HELD_LANGUAGES:
                            yield out()
                        counts[lang] = np.zeros(BUCKETS, np.int64)
                    counts[lang] += np.bincount(bucket[owner == lang], minlength=BUCKETS)
        yield out()

    rows = source.mapInArrow(run, "lang int, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n")).collect()
    counts = np.full((BUCKETS, len(languages)), ALPHA)
    for lang, bucket, n in rows:
        counts[bucket, lang] += n
    return languages, np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32)


def with_likelihoods(df: DataFrame, text: str, table: np.ndarray, out: str = "__ll") -> DataFrame:
    """All columns, ``out``: the tempered log-likelihood of each language, and ``__n``, the
    number of trigrams."""
    prepare(df.sparkSession)
    shared, at, names = df.sparkSession.sparkContext.broadcast(table), df.columns.index(text), [*df.columns, out, "__n"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        table = shared.value
        for batch in batches:
            found, sizes = [], []
            for _, texts in text_blocks(batch.column(at)):
                bucket, ends = trigrams(texts)
                sizes.append(np.diff(ends))
                found.append(np.add.reduceat(table[bucket], ends[:-1], axis=0, dtype=np.float64) * TEMPER)
            if found:
                flat = pa.array(np.concatenate(found).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * table.shape[1]), flat)
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(np.concatenate(sizes))], names)

    return df.mapInArrow(run, f"{_columns(df)}, `{out}` array<double>, __n bigint")


def _domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0)


def _counts(rows: DataFrame, by: Column, name: str, languages: int) -> DataFrame:
    """(name, n: rows of each language) for the values of ``by`` that are not null."""
    return (rows.where(by.isNotNull()).groupBy(by.alias(name))
            .agg(F.array(*[F.sum((F.col("best") == k).cast("double")) for k in range(languages)]).alias("n")))


def _smoothed(n: Column, prior: Column) -> Column:
    total = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(n, prior, lambda x, p: (x + p * STRENGTH) / (total + STRENGTH))


def expected_fit(table: np.ndarray) -> list[tuple[float, float]]:
    """(mean, variance) of a trigram's log-likelihood in each language. Neighbouring trigrams
    share bytes, so the variance counts three times."""
    share = np.exp(table.astype(np.float64))
    mean = (share * table).sum(axis=0)
    return list(zip(mean.tolist(), (3 * ((share * np.square(table, dtype=np.float64)).sum(axis=0) - mean**2)).tolist(), strict=True))


def _of(values: list[float], at: Column) -> Column:
    return F.array(*map(F.lit, values))[at]


def spread(rows: DataFrame, fit: list[tuple[float, float]]) -> list[float]:
    """The variance of each language's texts besides what their lengths explain, from light
    rows (best, x: mean log-likelihood, __n): one grouped aggregate. It is read off the 90th
    percentile of the squared deviations (2.7 variances), so foreign texts don't widen it."""
    mean, within = (_of([f[k] for f in fit], F.col("best")) for k in (0, 1))
    over = F.greatest(F.lit(0.0), F.pow(F.col("x") - mean, 2) - within / F.col("__n"))
    found = dict(rows.groupBy("best").agg(F.percentile_approx(over, 0.9) / 2.706).collect())  # at most one row a language
    return [found.get(k) or 0.0 for k in range(len(fit))]


def evidence(rows: DataFrame, languages: int) -> dict[str, DataFrame]:
    """Log tables by declared language, suffix and host from light rows (declared, suffix,
    host, __ll): key and one value a language."""
    best = F.expr("cast(array_position(__ll, array_max(__ll)) - 1 as int)")
    rows = rows.select("declared", "suffix", "host", best.alias("best"))
    total = [r or 0.0 for r in rows.agg(*[F.sum((F.col("best") == k).cast("double")) for k in range(languages)]).first()]
    out = {}
    for name in ("declared", "suffix"):
        counts = _counts(rows, F.col(name), name, languages)
        values = counts.count()
        log = F.transform(F.arrays_zip("n", F.array(*map(F.lit, total)).alias("t")), lambda x: F.log((x["n"] + ALPHA) / (x["t"] + ALPHA * (values + 1))))
        out[name] = counts.select(name, log.alias(f"__{name}"))
    corpus = F.array(*[F.lit((t + 1) / (sum(total) + languages)) for t in total])
    domains = _counts(rows, _domain(F.col("host")), "domain", languages).select("domain", _smoothed(F.col("n"), corpus).alias("p"))
    hosts = _counts(rows, F.col("host"), "host", languages).withColumn("domain", _domain(F.col("host")))
    out["host"] = hosts.join(domains, "domain").select("host", F.transform(_smoothed(F.col("n"), F.col("p")), lambda x: F.log(x)).alias("__host"))
    out["corpus"] = [math.log((t + 1) / (sum(total) + languages)) for t in total]
    return out


def identify(df: DataFrame, model: tuple[list[str], np.ndarray], text: str, declared: str | None = None,
             suffix: str | None = None, host: str | None = None, least: float = LEAST) -> DataFrame:
    """All columns and ``lang_id``, ``lang_p`` (posterior of that language) and ``lang_ok``.

    Missing evidence (no column, or null) says nothing; an unknown host has the corpus
    prior. A row is rejected (not ok) when its text has no letter, is null or empty, when
    no language reaches ``least``, or when its text fits the likeliest language far worse
    than that language's rows do (FIT), like other languages and random letters. Ties go to the first language by name. An empty
    table gives an empty result; columns of the input may have any names but those three
    and names that start with two underscores.
    """
    languages, table = model
    kept, size = df.columns, len(languages)
    if not size:
        return df.withColumns({"lang_id": F.lit(None).cast("string"), "lang_p": F.lit(0.0), "lang_ok": F.lit(False)})
    given = {n: F.col(c).cast("string") if c else F.lit(None).cast("string") for n, c in (("declared", declared), ("suffix", suffix), ("host", host))}
    df = with_likelihoods(df, text, table).withColumns({f"__at_{n}": c for n, c in given.items()})
    light = written(df.select(*[F.col(f"__at_{n}").alias(n) for n in given], "__ll", "__n"), "evidence")
    found, fit = evidence(light, size), expected_fit(table)
    best = F.expr("cast(array_position(__ll, array_max(__ll)) - 1 as int)")
    between = spread(light.select(best.alias("best"), (F.array_max("__ll") / TEMPER / F.col("__n")).alias("x"), "__n"), fit)
    for name in given:  # a small table is broadcast, so the texts are not dealt out by host
        table, _ = bounded_broadcast(found[name].withColumnRenamed(name, f"__at_{name}"), BROADCAST_ROWS)
        df = df.join(table, f"__at_{name}", "left")
    none, corpus = F.array(*[F.lit(0.0)] * size), F.array(*map(F.lit, found["corpus"]))
    parts = F.arrays_zip(F.col("__ll").alias("t"), F.coalesce("__declared", none).alias("d"), F.coalesce("__suffix", none).alias("s"), F.coalesce("__host", corpus).alias("h"))
    df = df.withColumn("__sum", F.transform(parts, lambda x: x["t"] + x["d"] + x["s"] + x["h"]))
    df = df.withColumn("__top", F.array_max("__sum"))
    posterior = 1 / F.aggregate("__sum", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("__top")))
    at = F.array_position("__sum", F.col("__top")).cast("int") - 1
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    low = _of([f[0] for f in fit], at) - FIT * F.sqrt(_of(between, at) + _of([f[1] for f in fit], at) / F.col("__n"))
    fits = F.col("__ll")[at] / TEMPER / F.col("__n") >= low
    return df.withColumns({"lang_id": _of(languages, at), "lang_p": posterior, "lang_ok": letters & (posterior >= least) & fits}).select(*kept, "lang_id", "lang_p", "lang_ok")


def from_page(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Adds text (tags, scripts and styles taken out), declared (the html element's lang), host
    and suffix (the host's last label). Null or malformed input gives nulls."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*+>.*?</\1>|<[^>]*+>", " ")
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))
    tag = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return pages.withColumns({"text": bare, "declared": F.nullif(F.lower(tag), F.lit("")), "host": host,
                              "suffix": F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit(""))})
