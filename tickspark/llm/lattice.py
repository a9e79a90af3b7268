"""Where the pieces of a vocabulary occur in a batch of words, found by suffix sorting."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Characters of a key; four of them make a 64-bit number, so batches and pieces may use up
# to 65 534 distinct characters of the vocabulary.
WIDTH = 16


@dataclass
class Edges:
    """Occurrences of pieces, sorted by the depth of their end: the characters from the
    word's first to the end. Positions count the characters of all words, one after the
    other, and an end is the position after the last character."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    first: np.ndarray  # whether the start is the word's first character
    bounds: np.ndarray  # of the words in positions
    cuts: np.ndarray  # edges of depth d are cuts[d] .. cuts[d + 1]


class Pieces:
    """Pieces of up to ``WIDTH`` characters, by their ids."""

    def __init__(self, pieces: dict[str, int]):
        long = [p for p in pieces if not 0 < len(p) <= WIDTH]
        if long:
            raise ValueError(f"pieces of 1 to {WIDTH} characters are expected: {long[:3]}")
        self.text = list(pieces)
        self.ids = np.array(list(pieces.values()), dtype=np.int64)
        self.sizes = np.array([len(p) for p in self.text])
        self.alphabet = np.unique(np.frombuffer("".join(self.text).encode("utf-32-le"), dtype="<u4"))
        if len(self.alphabet) > 65_533:
            raise ValueError("too many characters")
        flat = self.codes("".join(self.text))
        ends = np.cumsum(self.sizes)
        self.low = _keys(flat, np.repeat(ends, self.sizes), ends - self.sizes)
        fill = np.full(len(self.text), 0xFFFF, dtype=np.uint64)
        self.high = [k.copy() for k in self.low]
        for i in range(WIDTH):
            beyond = self.sizes <= i
            self.high[i // 4][beyond] |= (fill << np.uint64(16 * (3 - i % 4)))[beyond]

    def codes(self, text: str) -> np.ndarray:
        """Numbers of characters from 1; a character of no piece is 0xFFFE, in order last."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points
        return np.where(known, at + 1, 0xFFFE).astype(np.uint64)

    def edges(self, words: list[str], other: int | None = None) -> Edges:
        """All occurrences of pieces in the words; with ``other``, a character that is no
        piece by itself has one edge with that id."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        flat = self.codes("".join(words))
        stop = np.repeat(bounds[1:], sizes)
        keys = _keys(flat, stop, np.arange(len(flat)))
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        lo, hi = _below(keys, self.low, False), _below(keys, self.high, True)
        n = hi - lo
        hit = np.repeat(np.arange(len(n), dtype=np.int32), n)
        place = np.arange(int(n.sum()), dtype=np.int32) - np.repeat((np.cumsum(n) - n - lo).astype(np.int32), n)
        start = order.astype(np.int32)[place]
        size, piece = self.sizes.astype(np.int32)[hit], self.ids.astype(np.int32)[hit]
        if other is not None:
            have = np.zeros(len(flat), dtype=bool)
            have[start[size == 1]] = True
            bare = np.flatnonzero(~have).astype(np.int32)
            start = np.concatenate((start, bare))
            size = np.concatenate((size, np.ones(len(bare), dtype=np.int32)))
            piece = np.concatenate((piece, np.full(len(bare), other, dtype=np.int32)))
        begin = np.repeat(bounds[:-1].astype(np.int32), sizes)[start]
        longest = int(sizes.max(initial=0))
        depth = (start + size - begin).astype(np.uint16 if longest < 1 << 16 else np.int32)
        by = np.argsort(depth, kind="stable")
        start, size, piece, depth = start[by], size[by], piece[by], depth[by]
        cuts = np.searchsorted(depth, np.arange(1, longest + 2))
        return Edges(start, start + size, piece, depth.astype(np.int32) == size, bounds, cuts)


def _keys(flat: np.ndarray, stop: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The next ``WIDTH`` characters from each position on as numbers; 0 from ``stop`` on.
    ``stop`` is given for every position of ``flat``."""
    own = stop[at] if len(at) else at
    padded = np.concatenate((flat, np.zeros(WIDTH, dtype=np.uint64)))
    keys = []
    for k in range(WIDTH // 4):
        key = np.zeros(len(at), dtype=np.uint64)
        for i in range(4):
            j = at + 4 * k + i
            key = (key << np.uint64(16)) | np.where(j < own, padded[np.minimum(j, len(flat))], np.uint64(0))
        keys.append(key)
    return keys


def _below(keys: list[np.ndarray], wanted: list[np.ndarray], equal: bool) -> np.ndarray:
    """How many of the sorted keys are below each wanted one (or equal to it)."""
    lo = np.zeros(len(wanted[0]), dtype=np.int64)
    hi = np.full(len(wanted[0]), len(keys[0]), dtype=np.int64)
    while (go := lo < hi).any():
        mid = np.minimum((lo + hi) // 2, max(len(keys[0]) - 1, 0))
        less = np.full(len(lo), equal)
        for key, want in zip(keys[::-1], wanted[::-1]):
            less = np.where(key[mid] == want, less, key[mid] < want)
        lo = np.where(go & less, mid + 1, lo)
        hi = np.where(go & ~less, mid, hi)
    return lo
