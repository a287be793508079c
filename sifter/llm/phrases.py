"""Phrases mined from exact n-gram counts in counting quotient filters.

Frequent words get numbers. Every task packs the n-grams of word numbers into counting
quotient filters, cut into buckets by their first bits; the filters of a bucket are merged
over all tasks. A longer n-gram is counted only where both n-grams inside it may be frequent,
by a bit filter that has no false negatives. Candidates, cuts and ranks are joins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.bits import Filter, filter_bits, key_filter, rows_by_key, ship_filter
from sifter.llm.common import byte_blocks, prepare, written
from sifter.llm.files import local, ship_bytes
from sifter.llm.quotient import Layout, counted, merged, pack_filter, unpack_filter
from sifter.operators.common import bounded_broadcast

LEAST = 100
LONGEST = 5
#: Words with numbers at most; phrases with other frequent words are counted as texts.
LEXICON_WORDS = 1 << 19
#: Bytes of a word with a number at most.
WORD_BYTES = 64
#: N-grams that a task collects before it packs a filter, and that a bucket should hold.
GRAMS = 1 << 22
BUCKET = 1 << 20
#: Distinct words or phrases that a task counts before it hands them on.
HELD = 1 << 18

_SPLIT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def tokens(data: bytes) -> list[bytes]:
    """Words of a text with line feeds between its pieces, and empty strings."""
    return data.translate(_SPLIT).replace(b"\n", b" \n ").split(b" ")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """(langs, texts) of blocks of rows (lang, text)."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, texts in byte_blocks(batch.column(1)):
            yield langs[first: first + len(texts)], texts


def _count_rows(counts: dict[str, Counter]) -> pa.RecordBatch:
    langs = [lang for lang, c in counts.items() for _ in c]
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array([w for c in counts.values() for w in c], pa.binary()),
                                       pa.array([n for c in counts.values() for n in c.values()], pa.int64())], ["lang", "word", "n"])


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, word binary, n) of words with n >= ``least``, and a row with a null word that has
    the number of all words of the lang."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            for c in counts.values():
                c.pop(b"", None)
                c.pop(b"\n", None)
                c[None] = sum(c.values())
            rows = _count_rows(counts)
            counts.clear()
            return rows

        for langs, texts in _rows(batches):
            for lang, text in zip(langs, texts, strict=True):
                counts.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, counts.values())) > HELD:
                yield out()
        yield out()

    return (docs.mapInArrow(run, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= least) | F.col("word").isNull()))


def _lexicon(words: DataFrame, most: int) -> tuple[pa.Table, DataFrame]:
    """The most frequent short words (at most ``most``, whole count classes) and the others."""
    level = F.floor(F.log2("n") * 8).cast("int")
    short = words.where(F.octet_length("word") <= WORD_BYTES)
    total, cut = 0, None
    for at, size in sorted(short.groupBy(level.alias("level")).agg(F.count(F.lit(1))).collect(), reverse=True):
        total += size
        if total > most:
            break
        cut = at
    inside = (F.octet_length("word") <= WORD_BYTES) & (level >= F.lit(cut)) if cut is not None else F.lit(False)
    rows = sorted((r[0], bytes(r[1])) for r in words.where(inside).select("lang", "word").toLocalIterator())
    table = pa.table({"lang": pa.array([r[0] for r in rows], pa.string()), "word": pa.array([r[1] for r in rows], pa.binary())})
    return table, words.where(~inside)


def _ship_table(spark, table: pa.Table) -> str:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, table.schema) as writer:
        writer.write_table(table)
    return ship_bytes(spark, sink.getvalue().to_pybytes(), "words")


def _load_table(name: str) -> pa.Table:
    with pa.memory_map(local(name)) as source:
        return pa.ipc.open_file(source).read_all().combine_chunks()


def _numbers(name: str) -> dict[str, dict[bytes, int]]:
    """lang -> word -> number from 1."""
    table, out = _load_table(name), {}
    for k, (lang, word) in enumerate(zip(table.column("lang").to_pylist(), table.column("word").to_pylist(), strict=True)):
        out.setdefault(lang, {b"": -1})[word] = k + 1
    return out


def _encode(docs: DataFrame, lexicon: str) -> DataFrame:
    """Blocks of word numbers, 0 between runs of two or more neighbours that have one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, none = _numbers(lexicon), {b"": -1}
        for langs, texts in _rows(batches):
            found: list[int] = []
            for lang, text in zip(langs, texts, strict=True):
                get = numbers.get(lang, none).get
                found += [get(w, 0) for w in tokens(text)]
                found.append(0)
            ids = np.array(found, np.int32)
            ids = ids[ids >= 0]
            word = np.concatenate(([False], ids > 0, [False]))
            near = word[1:-1] & (word[:-2] | word[2:])
            stop = ~near
            stop[1:] &= near[:-1]
            ids[~near] = 0
            ids = ids[near | stop]
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array([ids.astype("<u4").tobytes()], pa.binary())], ["ids"])

    return docs.mapInArrow(run, "ids binary")


def _grams(ids: np.ndarray, layout: Layout, inner: Layout | None, seen: Filter | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Keys of the n-grams that may be frequent."""
    n = layout.n
    size = max(0, len(ids) - n + 1)
    alive = np.ones(size, bool)
    if seen is None:
        for k in range(n):
            alive &= ids[k: k + size] > 0
    else:
        whole = np.ones(size + 1, bool)
        for k in range(n - 1):
            whole &= ids[k: k + size + 1] > 0
        at = np.flatnonzero(whole) if size else np.zeros(0, np.int64)
        whole[at] = seen.holds(inner.hashes(*inner.pack([ids[at + k] for k in range(n - 1)]))) if len(at) else whole[at]
        alive = whole[:-1] & whole[1:] if size else alive
    at = np.flatnonzero(alive)
    return layout.pack([ids[at + k] for k in range(n)])


def count_grams(blocks: DataFrame, lexicon: str, n: int, bits: int, skip: int, least: int, inner: tuple[str, int] | None = None) -> DataFrame:
    """(lang, phrase, words int, a, hash) of the n-grams that occur ``least`` times or more.
    ``inner`` names the filter of frequent (n-1)-grams and its size."""
    layout = Layout(n, bits)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = Layout(n - 1, bits) if inner else None
        seen = Filter(*inner) if inner else None
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            low = np.concatenate([h[1] for h in held]) if layout.low else None
            top, low, counts = counted(np.concatenate([h[0] for h in held]), low)
            held.clear()
            bucket = (top >> np.uint64(layout.top - skip)).astype(np.int64) if skip else np.zeros(len(top), np.int64)
            first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            cuts = list(zip(first.tolist(), np.append(first[1:], len(top)).tolist(), strict=True))
            data = [pack_filter(layout, skip, top[s:e], None if low is None else low[s:e], counts[s:e]) for s, e in cuts]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(data, pa.binary())], ["bucket", "filter"])

        for batch in batches:
            for k in range(batch.num_rows):
                keys = _grams(np.frombuffer(batch.column(0)[k].as_buffer(), "<u4"), layout, before, seen)
                if len(keys[0]):
                    held.append(keys)
                    if sum(len(h[0]) for h in held) > GRAMS:
                        yield out()
        if held:
            yield out()

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _load_table(lexicon)

        def out(bucket: int, parts: list[tuple]) -> pa.RecordBatch:
            top, low, counts = merged(parts)
            keep = counts >= least
            top, low, counts = top[keep], None if low is None else low[keep], counts[keep]
            at = [pa.array(w.astype(np.int64) - 1) for w in layout.unpack(top, low)]
            phrase = pc.binary_join_element_wise(*[words.column("word").take(a).combine_chunks() for a in at], b" ").cast(pa.string())
            lang = words.column("lang").take(at[0]).combine_chunks()
            return pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(top), n, np.int32)), pa.array(counts), pa.array(layout.hashes(top, low).view(np.int64))],
                                              ["lang", "phrase", "words", "a", "hash"])

        now, parts, size = None, [], 0
        for bucket, (data,) in rows_by_key(batches):
            if bucket != now:
                if parts:
                    yield out(now, parts)
                now, parts, size = bucket, [], 0
            parts.append(unpack_filter(layout, skip, bucket, data))
            size += len(parts[-1][0])
            if size > BUCKET and size > 2 * len(parts[0][0]):
                parts = [merged(parts)]
                size = len(parts[0][0])
        if parts:
            yield out(now, parts)

    filters = blocks.mapInArrow(scan, "bucket bigint, filter binary").repartition("bucket").sortWithinPartitions("bucket")
    return filters.mapInArrow(merge, PHRASES + ", hash bigint")


PHRASES = "lang string, phrase string, words int, a bigint"


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b" " + word)


def _text_grams(docs: DataFrame, lexicon: str, rest: DataFrame, n_rest: int, longest: int, least: int) -> DataFrame:
    """Phrases that hold a frequent word without a number, counted as texts. Which words
    those are is asked of a bit filter; what it lets through in excess stays rare."""
    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_word_hash(lang, word) for lang, word in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(found, np.uint64).view(np.int64))], ["hash"])

    bits = filter_bits(n_rest)
    name = ship_filter(key_filter(rest.select("lang", "word").mapInArrow(hashed, "hash bigint"), bits), bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, seen, counts = _numbers(lexicon), Filter(name, bits), {}
        for langs, texts in _rows(batches):
            for lang, text in zip(langs, texts, strict=True):
                known, total = numbers.get(lang, {b"": -1}), counts.setdefault(lang, Counter())
                words = [w for w in tokens(text) if w]
                new = [w for w in dict.fromkeys(words) if w not in known and w != b"\n"]
                others = {w for w, hit in zip(new, seen.holds(np.array([_word_hash(lang, w) for w in new], np.uint64)).tolist(), strict=True) if hit}
                fine = [w in known or w in others for w in words]
                for k, w in enumerate(words):
                    if w not in others:
                        continue
                    low, high = k, k + 1  # n-grams whose first such word is at k
                    while low > 0 and k - low < longest - 1 and fine[low - 1] and words[low - 1] not in others:
                        low -= 1
                    while high < len(words) and high - k < longest and fine[high]:
                        high += 1
                    total.update(b" ".join(words[s:e]) for s in range(low, k + 1) for e in range(max(k + 1, s + 2), min(high, s + longest) + 1))
            if sum(map(len, counts.values())) > HELD:
                yield _count_rows(counts)
                counts = {}
        yield _count_rows(counts)

    grams = docs.mapInArrow(run, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    phrase = F.col("word").cast("string")
    return grams.select("lang", phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("words"), "a")


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lexicon_words: int = LEXICON_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((lang, n) of all words, (lang, phrase, a) of frequent words, (lang, phrase, words, a)
    of frequent phrases of 2 to ``longest`` words) of ``docs`` (lang, text)."""
    spark = docs.sparkSession
    counts = written(word_counts(docs, least), "words")
    words = counts.where("word is not null")
    table, rest = _lexicon(words, lexicon_words)
    lexicon, bits = _ship_table(spark, table), max(1, len(table).bit_length())
    blocks = written(_encode(docs, lexicon), "numbers")
    total = int(blocks.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // 4
    found, inner = [], None
    for n in range(2, longest + 1):
        skip = min(Layout(n, bits).top, max(0, (total // BUCKET).bit_length()))
        grams = written(count_grams(blocks, lexicon, n, bits, skip, least, inner), "grams")
        some = grams.count()
        if not some:
            break
        found.append(grams.drop("hash"))
        size = filter_bits(some)
        inner = ship_filter(key_filter(grams.select("hash"), size), size), size
    n_rest = rest.count()
    if n_rest:
        found.append(written(_text_grams(docs, lexicon, rest, n_rest, longest, least), "texts"))
    phrases = found[0] if found else spark.createDataFrame([], PHRASES)
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    return (counts.where("word is null").select("lang", "n"), words.select("lang", F.col("word").cast("string").alias("phrase"), F.col("n").alias("a")), phrases)


def collocations(df: DataFrame, top: int | None, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's ``top`` phrases (None: all, without
    rank), by score, then frequency, then text.

    Texts are lower-cased (A-Z) and cut into pieces at ``. , ; : ! ?`` and line breaks, and
    into words at blanks and tabs. A phrase of 2 to ``longest`` words that occurs ``least``
    times or more is scored floor(1000 a n / (l r)) at its weakest cut (ties: the first);
    phrases inside a longer one that is as frequent are dropped. A null lang is ``und``, a
    null text empty; repeated rows count again; an empty table gives an empty result.
    """
    prepare(df.sparkSession)
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    totals, words, phrases = phrase_counts(docs, least, longest, lexicon_words)
    split = phrases.select("lang", "phrase", "words", "a", F.split("phrase", " ").alias("w"))

    def part(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    cuts = split.select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("left"), F.col("k").alias("size"), part(F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("left"), (F.col("words") - F.col("k")).alias("size"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("part")))).alias("p"))
    cuts = cuts.select("lang", "phrase", "a", "k", "p.*")
    # one-word parts are the hot keys; their table is broadcast when it is the bounded lexicon
    ones = words.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    if words.agg(F.count(F.lit(1)) <= lexicon_words, F.sum(F.octet_length("phrase")) <= lexicon_words * WORD_BYTES // 2).first() == (True, True):
        ones = F.broadcast(ones)
    more = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    sides = cuts.where("size = 1").join(ones, ["lang", "part"]).unionByName(cuts.where("size > 1").join(more, ["lang", "part"]))
    pairs = sides.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    scored = pairs.join(bounded_broadcast(totals, 1 << 20)[0], "lang").withColumn(
        "score", F.expr("(cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(19, 0)) * r)"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # what is inside a longer phrase as frequent is inside one that is longer by one word
    inside = split.where("words > 2").select("lang", "a", F.explode(F.array(part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    rows = (best.join(inside, ["lang", "phrase"], "left").where("longer is null or longer < a")
            .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))
    if top is None:
        return rows
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
