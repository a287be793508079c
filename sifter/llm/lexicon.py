"""Minimal acyclic transducer: sorted byte words to id sequences.

Words are added in order and equal suffix states are shared. Every transition carries how
many words precede those behind it; the sum along a word's path is its number, which
points to its ids. The arrays lie in one file that is mapped into memory, so all workers of
a machine share its pages.
"""

from __future__ import annotations

import mmap
from collections.abc import Sequence

import numpy as np

_FIELDS = (("keys", np.int64), ("target", np.int32), ("skip", np.int32), ("final", np.uint8), ("at", np.int64), ("ids", np.uint32))


class _State:
    __slots__ = ("final", "edges", "words", "number")

    def __init__(self):
        self.final, self.edges, self.words, self.number = False, {}, 0, -1


def compile_words(words: Sequence[bytes], outputs: Sequence[Sequence[int]]) -> bytes:
    """The file of the minimal automaton of ``words``, distinct and in ascending order,
    with ``outputs`` as the ids of each."""
    root, register, path = _State(), {}, []  # path: (parent, label, state) not yet shared

    def share(down_to: int) -> None:
        while len(path) > down_to:
            parent, label, state = path.pop()
            mark = (state.final, tuple((x, id(s)) for x, s in state.edges.items()))
            parent.edges[label] = register.setdefault(mark, state)

    last = b""
    for word in words:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        if path and word <= last:
            raise ValueError("words must be distinct and ascending")
        share(same)
        state = path[-1][2] if path else root
        for label in word[same:]:
            nxt = _State()
            state.edges[label] = nxt
            path.append((state, label, nxt))
            state = nxt
        state.final = True
        last = word
    share(0)

    order, stack = [], [(root, False)]
    while stack:  # children first, to count the words below each state
        state, done = stack.pop()
        if done:
            state.words = state.final + sum(s.words for s in state.edges.values())
            order.append(state)
        elif state.number < 0:
            state.number = 0
            stack.append((state, True))
            stack.extend((s, False) for s in state.edges.values())
    order.reverse()
    for number, state in enumerate(order):
        state.number = number
    keys, target, skip = [], [], []
    for state in order:
        before = int(state.final)
        for label in sorted(state.edges):
            child = state.edges[label]
            keys.append(state.number << 8 | label)
            target.append(child.number)
            skip.append(before)
            before += child.words
    lengths = np.fromiter(map(len, outputs), np.int64, len(outputs))
    arrays = {"keys": keys, "target": target, "skip": skip, "final": [s.final for s in order],
              "at": np.concatenate(([0], np.cumsum(lengths))), "ids": [i for ids in outputs for i in ids]}
    parts = [np.asarray(arrays[name], kind) for name, kind in _FIELDS]
    head = np.array([max(map(len, words), default=0), *map(len, parts)], np.int64).tobytes()
    return head + b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)


class Lexicon:
    """The automaton in a file, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(data, np.int64, 1 + len(_FIELDS))
        self.longest, at = int(head[0]), head.nbytes
        for (name, kind), count in zip(_FIELDS, head[1:].tolist(), strict=True):
            part = np.frombuffer(data, kind, count, at)
            setattr(self, name, part)
            at += part.nbytes + -part.nbytes % 8

    def numbers(self, words: Sequence[bytes]) -> np.ndarray:
        """Each word's number, -1 for words that are not in the lexicon; all words walk the
        automaton together, one byte a step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        number[lengths > self.longest] = -1
        alive = np.flatnonzero(number >= 0) if len(self.keys) else np.zeros(0, np.int64)
        if not len(self.keys):
            number[lengths > 0] = -1
        for depth in range(self.longest):
            alive = alive[lengths[alive] > depth]
            if not len(alive):
                break
            key = state[alive] << 8 | text[starts[alive] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[edge] == key
            number[alive[~found]] = -1
            alive, edge = alive[found], edge[found]
            state[alive] = self.target[edge]
            number[alive] += self.skip[edge]
        ends = number >= 0
        number[ends] = np.where(self.final[state[ends]] == 1, number[ends], -1)
        return number

    def output(self, number: int) -> list[int]:
        return self.ids[self.at[number]: self.at[number + 1]].tolist()
