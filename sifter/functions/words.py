"""T1-T7, n-gram counts and MinHash values by distinct words, for whole corpora.

The expressions of ``functions.text`` say what a token, a kept token and a lemma are. A corpus has
few distinct words, so here a worker works out each word once: a text is lower-cased and cut at
whitespace in one pass over its bytes, and what a word becomes is looked up. Results are equal.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sifter.functions import hashing
from sifter.functions import text as T
from sifter.params import Params

WORDS_KNOWN = 1 << 16  # words that a worker remembers
SLOT_WORDS = 1 << 12  # words of a text that meet all slots at once
BLOCK_TOKENS = 1 << 17  # tokens whose n-grams are counted at once, or those of one text

_WIDE_SPACE = re.compile(f"[{''.join(c for c in map(chr, range(128, 0x3001)) if c.isspace())}]")
_SPACE = b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
_TO_SPACE = bytes(32 if b in _SPACE else b for b in range(256))
_DELETED = bytes(b for b in range(256) if not (97 <= b <= 122 or b == 39 or b in _SPACE))
_CLITIC = re.compile(T.CLITIC_RE)


class Lemmas(dict):
    """The lemma of a raw token (bytes), None if it is not kept; emptied when full."""

    def __init__(self, params: Params, rules=T.LEMMA_RULES):
        super().__init__()
        self.least, self.stopwords = params.min_token_chars, frozenset(params.stopwords)
        self.rules = [(suffix, least, extra and re.compile(extra), new) for suffix, least, extra, new in rules]

    def __missing__(self, token: bytes) -> str | None:
        if len(self) >= WORDS_KNOWN:
            self.clear()
        word = token.decode()
        if "'" in word:
            word = _CLITIC.sub("", word)
        lemma = None
        if len(word) >= self.least and word not in self.stopwords:
            lemma = word
            for suffix, least, extra, new in self.rules:
                if word.endswith(suffix) and len(word) >= least and (extra is None or extra.search(word)):
                    lemma = word[:len(word) - len(suffix)] + new
                    break
        self[token] = lemma
        return lemma


@functools.cache
def lemmas_of(params: Params) -> Lemmas:
    return Lemmas(params)


def raw_tokens(text: str) -> list[bytes]:
    """Tokens of the normalised text before quotes are trimmed: T1 leaves nothing but a-z, the
    apostrophe and whitespace, so they are what whitespace separates."""
    low = text.lower()
    if not low.isascii():
        low = _WIDE_SPACE.sub(" ", low)
    return low.encode("ascii", "ignore").translate(_TO_SPACE, _DELETED).split()


def processed(text: str, known: Lemmas) -> str:
    """T1-T7 of a text."""
    return " ".join([w for w in map(known.__getitem__, raw_tokens(text)) if w is not None])


def _spans(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with ``limit`` items at most, or one row."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield at, stop
        at = stop


def gram_counts(rows: int, row: np.ndarray, text: np.ndarray, words: pa.Array, codes: np.ndarray,
                among: pa.Array | None = None) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """``(row, gram, count, total)`` of the word 1- to 3-grams of tokens ``codes`` (places in ``words``), which do
    not cross texts; ``total`` is the sum of squares of all counts of the row. ``among`` keeps those grams only.

    A 2-gram is numbered by two words' numbers, a 3-gram by a 2-gram's number and a word's."""
    n, width = len(codes), max(1, len(words))
    found, spelled, last = [], [words], codes
    for size in (1, 2, 3):
        at = np.arange(max(0, n - size + 1))
        at = at[text[at] == text[at + size - 1]]
        if size > 1:  # last[i] is the number of the shorter gram that starts at token i
            pairs, number = np.unique(last[at] * width + codes[at + size - 1], return_inverse=True)
            spelled.append(pc.binary_join_element_wise(spelled[-1].take(pa.array(pairs // width)), words.take(pa.array(pairs % width)), " "))
            last = np.zeros(n, np.int64)
            last[at] = number
        kinds = max(1, len(spelled[-1]))
        keys, count = np.unique(row[at] * kinds + last[at], return_counts=True)
        found.append((keys // kinds, keys % kinds, count))
    total = np.zeros(rows, np.int64)
    for r, _, count in found:
        np.add.at(total, r, count * count)
    for grams, (r, gram, count) in zip(spelled, found, strict=True):
        if among is not None:
            keep = pc.is_in(grams, value_set=among).to_numpy(zero_copy_only=False)[gram]
            r, gram, count = r[keep], gram[keep], count[keep]
        if len(r):
            yield r, grams.take(pa.array(gram)), count, total[r]


def count_batch(ids: pa.Array, texts: pa.Array, among: pa.Array | None = None) -> Iterator[list[pa.Array]]:
    """Columns id, term, tf, total of a batch of ids and, for each, the token lists of its texts."""
    lists = texts.flatten()
    of_text = np.repeat(np.arange(len(ids)), texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    tokens, first = lists.flatten(), np.concatenate(([0], np.cumsum(lengths)))
    sizes = np.bincount(of_text, lengths, len(ids)).astype(np.int64)
    begins = np.searchsorted(of_text, np.arange(len(ids) + 1))
    for a, b in _spans(sizes, BLOCK_TOKENS):
        lo, hi = begins[a], begins[b]
        some = tokens.slice(first[lo], first[hi] - first[lo]).dictionary_encode()
        if len(some):
            text = np.repeat(np.arange(lo, hi), lengths[lo:hi])
            codes = some.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for r, gram, count, total in gram_counts(b - a, of_text[text] - a, text, some.dictionary, codes, among):
                yield [ids.take(pa.array(r + a)), gram, pa.array(count.astype(np.int64)), pa.array(total)]


class SlotValues:
    """MinHash values of words, ``(a*h + b) mod (2^31 - 1)`` a slot; a worker works a word out once, and
    forgets all when full."""

    def __init__(self, params: Params):
        coeffs = np.array(hashing.minhash_coefficients(params.minhash_perms, params.minhash_seed), dtype=np.int64)
        self.a, self.b = coeffs[:, 0], coeffs[:, 1]
        self.at: dict[str, int] = {}
        self.values = np.zeros((WORDS_KNOWN, len(coeffs)), np.int32)

    def places(self, words: list[str]) -> np.ndarray:
        """Rows of ``values`` of at most WORDS_KNOWN words."""
        new = [w for w in words if w not in self.at]
        if len(self.at) + len(new) > WORDS_KNOWN:
            self.at.clear()
            new = list(dict.fromkeys(words))
        for low in range(0, len(new), 1024):
            some = new[low:low + 1024]
            h = np.array([int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in some], np.int64)
            self.values[len(self.at):len(self.at) + len(some)] = (h[:, None] * self.a + self.b) % hashing.MERSENNE_31  # products stay below 2^59
            self.at.update(zip(some, range(len(self.at), len(self.at) + len(some))))
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))

    def signature(self, words: list[str]) -> np.ndarray:
        """Slot minima of a text's words, of which there is one at least."""
        best = None
        for low in range(0, len(words), SLOT_WORDS):
            part = self.values[self.places(words[low:low + SLOT_WORDS])].min(axis=0)
            best = part if best is None else np.minimum(best, part)
        return best


@functools.cache
def slot_values(params: Params) -> SlotValues:
    return SlotValues(params)
