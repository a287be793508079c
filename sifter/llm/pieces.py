"""Ids of texts from the ids of their pieces, each worked out once while it is remembered."""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sifter.llm.common import ragged

#: A worker remembers so many pieces of at most so many characters (about 200 bytes each), those
#: it meets first; further and longer ones for a block of texts.
MEMO_PIECES = 1 << 18
PIECE_BYTES = 64


class _Codes(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __missing__(self, key):
        code = self[key] = len(self)
        return code


class PieceMemo:
    """Subclasses say how to ``cut`` a text and which ids new pieces have."""

    def __init__(self, most: int = MEMO_PIECES):
        self.most = most
        self.codes, self.learnt = _Codes(), 0
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def cut(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, list, np.ndarray]]:
        """Parts of a block: (texts' numbers, pieces of each, distinct pieces, which of them each
        piece is). Every text is in one part."""
        raise NotImplementedError

    def ids_of(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in one array, number of ids of each)."""
        raise NotImplementedError

    @staticmethod
    def distinct(rows: np.ndarray, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
        """A part from the lists of the texts' pieces."""
        found = lists.flatten().dictionary_encode()
        return rows, np.diff(lists.offsets.to_numpy()), found.dictionary.to_pylist(), found.indices.to_numpy()

    def _learn(self, pieces: list) -> None:
        ids, lengths = self.ids_of(pieces)
        first, last = self.learnt, self.learnt + len(pieces)
        while last > len(self.at):
            self.at, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.at, self.size))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used: self.used + len(ids)] = ids
        self.at[first:last] = self.used + np.cumsum(lengths) - lengths
        self.size[first:last] = lengths
        self.used, self.learnt = self.used + len(ids), last

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, where each text's ids start and the last end). Null
        texts count as empty."""
        full = self.learnt
        owner, codes, counts = [], [], np.zeros(len(texts), np.int64)
        for rows, sizes, distinct, of in self.cut(pc.fill_null(texts, "")):
            counts[rows] = sizes
            owner.append(np.repeat(rows, sizes))
            codes.append(np.fromiter(map(self.codes.__getitem__, distinct), np.int64, len(distinct))[of])
        codes = np.concatenate(codes)
        if len(owner) > 1:
            codes = codes[np.argsort(np.concatenate(owner), kind="stable")]
        ends = np.concatenate(([0], np.cumsum(counts)))
        new = []
        if len(self.codes) > full:
            new = list(islice(reversed(self.codes), len(self.codes) - full))[::-1]
            self._learn(new)
        sizes = self.size[codes]
        at = np.concatenate(([0], np.cumsum(sizes)))
        out = self.ids[ragged(self.at[codes], sizes)], at[ends]
        # long pieces, and those beyond the bound, go again: from the first of them on
        last = next((k for k, piece in enumerate(new) if full + k >= self.most or len(piece) > PIECE_BYTES), len(new))
        if last < len(new):
            for piece in new[last:]:
                del self.codes[piece]
            self.used, self.learnt = int(self.at[full + last]), full + last
            if len(self.ids) > 1 << 20 and self.used < len(self.ids) // 4:
                self.ids = self.ids[: len(self.ids) // 2].copy()
        return out
