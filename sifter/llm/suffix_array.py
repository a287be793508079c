"""Suffix arrays of many short texts in numpy: refinement by doubling, common prefixes."""

from __future__ import annotations

import numpy as np

#: Symbols of 9 bits (0: behind the end, else byte + 1) in one integer key.
PACK = 7


def packed(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position its next PACK symbols, as far as its own text goes (``ends``)."""
    n = len(text)
    room = ends - np.arange(n)
    symbols = np.zeros(n + PACK, np.int64)
    symbols[:n] = text.astype(np.int64) + 1
    keys = np.zeros(n, np.int64)
    for k in range(PACK):
        keys = keys << 9 | np.where(room > k, symbols[k: k + n], 0)
    return keys


def _numbered(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For sorted keys the place (from ``first``) of the first equal one."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return first[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]


def suffix_array(keys: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each suffix) by Larsson-Sadakane refinement: only groups
    of suffixes that are still equal are sorted again, by the rank of what follows after
    the symbols compared so far; that length doubles. Texts end with marks that differ and
    sort before all bytes, by ``owner``."""
    n = len(keys)
    order = np.argsort(keys).astype(np.int32)
    places, ends, owner = np.arange(n, dtype=np.int32), ends.astype(np.int32), owner.astype(np.int32)
    rank = np.empty(n, np.int32)
    rank[order] = _numbered(keys[order], places)
    texts = int(owner[-1]) + 1 if n else 0
    length, open_ = PACK, places  # places in ``order`` whose group is not resolved
    while True:
        group = rank[order[open_]]
        same = np.zeros(len(open_) + 1, bool)
        same[1:-1] = group[1:] == group[:-1]
        keep = same[:-1] | same[1:]
        open_, group = open_[keep], group[keep]
        if not len(open_):
            return order, rank
        suffix = order[open_]
        after = suffix + np.int32(length)
        inside = after < ends[suffix]
        follow = np.where(inside, rank[np.minimum(after, n - 1)] + texts, owner[suffix])
        key = group.astype(np.int64) * (n + texts + 1) + follow
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[open_] = suffix
        rank[suffix] = _numbered(key, open_)
        length *= 2


def common_prefixes(keys: np.ndarray, order: np.ndarray, rank: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = 1) -> np.ndarray:
    """Kasai's algorithm: for each place in ``order`` the common prefix with the place before,
    worked out for suffixes of at least ``least`` symbols, 0 for shorter ones. A text's
    suffixes are taken from left to right, each starting from what the last one had less
    one symbol; all texts advance together."""
    n = len(keys)
    starts, ends = starts.astype(np.int32), ends.astype(np.int32)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    prefix = np.zeros(n, np.int32)
    sizes = ends[starts] - starts - np.int32(least - 1)
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    have = np.zeros(len(starts), np.int32)
    for step in range(int(sizes.max(initial=0))):
        alive = int(np.searchsorted(-sizes, -step))  # texts longer than step come first
        i = starts[:alive] + np.int32(step)
        j = before[i]
        most = np.where(j >= 0, np.minimum(ends[i] - i, ends[np.maximum(j, 0)] - j), 0)
        h = np.minimum(np.maximum(have[:alive] - 1, 0), most)
        todo = np.flatnonzero(h < most)
        while len(todo):
            at = h[todo]
            differ = keys[i[todo] + at] ^ keys[j[todo] + at]
            top = np.frexp((differ & ~(differ >> 1)).astype(np.float64))[1]  # bits up to the highest that differs
            gain = (9 * PACK - top) // 9
            full = most[todo]
            h[todo] = now = np.minimum(at + gain, full)
            todo = todo[(differ == 0) & (now < full)]
        have[:alive] = h
        prefix[rank[i]] = h
    return prefix
