"""BPE encoding and decoding of whole texts with a lexicon of frequent words.

Spark counts the words of the whole corpus; the frequent ones are merged once and compiled
into a minimal acyclic transducer, which every worker maps into memory. All other words are
merged exactly where they occur. White space never lies inside a token of this vocabulary
kind, so a text's ids are those of its pieces between ASCII white space, one by one.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sifter.llm.common import array_blocks, held, prepare, text_blocks, written
from sifter.llm.files import local, ship, ship_bytes
from sifter.llm.lexicon import Lexicon, compile_words
from sifter.llm.pieces import MEMO_PIECES, PieceMemo

#: Most words of the lexicon; rarer words are merged where they occur.
LEXICON_WORDS = 1 << 18

# Up to U+017F characters are their own normal form and every letter is one of these.
_LATIN = re.compile("[!-~\u00a1-\u012f\u0131-\u017f]+")
_LATIN_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]"
                         "|[^\\sa-z0-9\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f\u00b2\u00b3\u00b9\u00bc-\u00be]+")


class WordBpe:
    """A BPE vocabulary with word ends, read from a tokenizers file. Normalising and cutting
    of pieces beyond Latin letters is left to the file's own normaliser and pre-tokeniser."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, tok = spec["model"], Tokenizer.from_file(path)
        self.normal, self.cut = tok.normalizer.normalize_str, tok.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        chars = sorted(byte_chars().items())
        self.byte_of = {c: b for b, c in chars}
        self.inner, self.last = [vocab[c] for _, c in chars], [vocab[c + end] for _, c in chars]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        self.rank, self.joined, self.none = {a << 32 | b: k for k, (a, b, _) in enumerate(merges)}, [c for _, _, c in merges], len(merges)
        size = 1 + max(max(vocab.values()), *self.special.values())
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *((k.decode(), v) for k, v in self.special.items())]:
            self.tokens[i] = token

    def words(self, piece: bytes) -> list[bytes | int]:
        """The words of a piece without ASCII white space; special tokens as their ids."""
        if b"<|" in piece:
            parts = self.special_at.split(piece)
            if len(parts) > 1:
                return [w for k, p in enumerate(parts) for w in ([self.special[p]] if k % 2 else self.words(p))]
        text = piece.decode()
        if _LATIN.fullmatch(text):
            return [w.encode() for w in _LATIN_WORD.findall(text.lower())]
        byte_of = self.byte_of
        return [bytes([byte_of[c] for c in word]) for word, _ in self.cut(self.normal(text))]

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word: the lowest-ranked pair is joined, leftmost first, until none is left."""
        ids = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        if len(ids) > 64:
            return self._merge_long(ids)
        find, none = self.rank.get, self.none
        ranks = [find(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            k = ranks.index(best)
            ids[k] = self.joined[best]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = find(ids[k - 1] << 32 | ids[k], none)
            if k < len(ranks):
                ranks[k] = find(ids[k] << 32 | ids[k + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over linked symbols, for long runs without white space."""
        import heapq

        find, n = self.rank.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := find(ids[k] << 32 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        ids = [*ids, -1]
        while heap:
            rank, k, a, b = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] != a or nxt >= n or ids[nxt] != b:
                continue
            ids[k], ids[nxt] = self.joined[rank], -1
            after[k] = after[nxt]
            if after[k] < n:
                before[after[k]] = k
            for i in (before[k], k):
                if i >= 0 and after[i] < n and (r := find(ids[i] << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[after[i]]))
        return [i for i in ids if i >= 0]

    def decode(self, ids: list[int]) -> str:
        """What the file's missing decoder gives: the tokens, joined by single spaces."""
        return " ".join(map(self.tokens.__getitem__, ids))


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _vocabulary(name: str) -> WordBpe:
    return held(("word bpe", name), lambda: WordBpe(local(name)))


class Encoder(PieceMemo):
    """Ids of texts: words by the lexicon, or merged where it does not have them."""

    def __init__(self, bpe: WordBpe, lexicon: Lexicon):
        super().__init__()
        self.bpe, self.lexicon = bpe, lexicon

    def cut(self, texts: pa.Array) -> list:
        lists = pc.ascii_split_whitespace(texts)
        return [self.distinct(np.arange(len(texts)), lists.cast(pa.list_(pa.binary())))]

    def ids_of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.bpe.words(p) for p in pieces]
        new = [w for w in dict.fromkeys(w for ws in cut for w in ws) if type(w) is bytes]
        of = {w: self.lexicon.output(n) if n >= 0 else self.bpe.merge(w) for w, n in zip(new, self.lexicon.numbers(new).tolist(), strict=True)}
        found = [of[ws[0]] if len(ws) == 1 and type(ws[0]) is bytes else [i for w in ws for i in (of[w] if type(w) is bytes else (w,))] for ws in cut]
        return np.array([i for ids in found for i in ids], np.uint32), np.fromiter(map(len, found), np.int64, len(found))


def _encoder(vocabulary: str, lexicon: str) -> Encoder:
    """One for all tasks of a worker process, so what it remembers lasts."""
    return held(("word encoder", vocabulary, lexicon), lambda: Encoder(WordBpe(local(vocabulary)), Lexicon(local(lexicon))))


def word_counts(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """(word binary, n long) over all rows; each task adds up its words before the shuffle."""
    prepare(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = _vocabulary(vocabulary), Counter()

        def words() -> pa.RecordBatch:
            total: dict[bytes, int] = {}
            for piece, n in pieces.items():
                for w in bpe.words(piece):
                    if type(w) is bytes:
                        total[w] = total.get(w, 0) + n
            pieces.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for _, texts in text_blocks(batch.column(0)):
                for t in texts:
                    pieces.update(t.encode().split())
                if len(pieces) > MEMO_PIECES:
                    yield words()
        yield words()

    return df.select(text).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = LEXICON_WORDS) -> list[bytes]:
    """At most ``most`` words, the frequent ones: the count from which they fit is read off
    a histogram of at most 65 * 8 rows."""
    level = F.floor(F.log2("n") * 8).cast("int").alias("level")
    rows = sorted(counts.groupBy(level).agg(F.count(F.lit(1)), F.min("n")).collect(), reverse=True)
    total, least = 0, None
    for _, words, lowest in rows:
        total += words
        if total > most:
            break
        least = lowest
    return sorted(bytes(r[0]) for r in counts.where(F.col("n") >= least).select("word").collect()) if least is not None else []


def build_lexicon(df: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> tuple[str, str]:
    """Count, merge and compile the frequent words of ``df``; returns the names of the
    shipped vocabulary and lexicon."""
    spark = df.sparkSession
    vocabulary = ship(spark, path)
    words = frequent_words(written(word_counts(df, vocabulary, text), "words"), most)
    bpe = WordBpe(path)
    return vocabulary, ship_bytes(spark, compile_words(words, [bpe.merge(w) for w in words]), "lexicon")


def encode(df: DataFrame, path: str, keys: list[str], text: str = "text", most: int = LEXICON_WORDS,
           decode: bool = False) -> DataFrame:
    """``keys`` and ``ids``: the token ids of the whole text as little-endian unsigned 32-bit
    integers in one binary; with ``decode`` also ``decoded``, the text made from those ids.

    A null text counts as empty and gets an empty binary; so does white space alone.
    Repeated rows come out repeated, an empty table gives an empty result. ``path`` is a
    vocabulary file that the driver reads and Spark hands to the executors.
    """
    vocabulary, lexicon = build_lexicon(df, path, text, most)
    source = df.select(*keys, F.col(text).alias("__text"))
    names = [*keys, "ids", *["decoded"] * decode]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]] + ["ids binary"] + ["decoded string"] * decode)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, lexicon)
        for batch in batches:
            for first, texts in array_blocks(batch.column(batch.num_columns - 1)):
                ids, ends = encoder.encode(texts)
                ends = ends.tolist()
                data = ids.astype("<u4").tobytes()
                out = [pa.array([data[4 * s: 4 * e] for s, e in zip(ends, ends[1:])], pa.binary())]
                if decode:
                    out.append(pa.array([encoder.bpe.decode(ids[s:e].tolist()) for s, e in zip(ends, ends[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(texts)).columns[:-1], *out], names)

    return source.mapInArrow(run, schema)
