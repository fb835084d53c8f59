"""A bidirectional FM-index of a sorted vocabulary, searched for one error.

The words stand one after another with a delimiter before each and after the
last. An interval of suffix ranks says where a pattern occurs; extending the
pattern by a symbol, to either side, moves the interval on that side's index by
two rank look-ups and narrows the other side's along with it. The rank of a
delimiter's suffix is the number of the word behind it, so a whole word's
interval names it.

All patterns of a call move together, one symbol a step, as arrays.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

TOGETHER = 4096  # patterns


def _suffixes(text: np.ndarray, delimiters: int) -> np.ndarray:
    """Start of each suffix in sorted order, by doubling; a delimiter (0) is
    smaller than every symbol and than the delimiters behind it."""
    at = text == 0
    rank = text.astype(np.int64) + delimiters
    rank[at] = np.arange(delimiters)
    n, step = len(text), 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + delimiters + 257) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([False], np.diff(key[order]) != 0)).cumsum()
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class _Side:
    """The symbols before each suffix of a text, and how many of each, or smaller
    ones, stand in every prefix of them."""

    def __init__(self, text: np.ndarray, sigma: int, delimiters: int):
        order = _suffixes(text, delimiters)
        before = text[order - 1]
        before[order == 0] = sigma  # nothing stands before the text
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        blocks = len(text) // 64 + 1
        padded = np.full(blocks * 64, sigma, dtype=before.dtype)
        padded[:len(before)] = before
        self.bits = [np.empty((blocks, sigma), dtype=np.uint64) for _ in range(2)]
        for c in range(sigma):
            for bits, flags in zip(self.bits, (padded == c, padded < c)):
                bits[:, c] = np.packbits(flags, bitorder="little").view(np.uint64)
        self.sums = [np.cumsum(np.bitwise_count(b), axis=0, dtype=np.int32) - np.bitwise_count(b) for b in self.bits]

    def count(self, c, at: np.ndarray, smaller: bool = False) -> np.ndarray:
        """Symbols c (or smaller ones) among the first ``at``; c: one a place, or
        a slice for a row of symbols a place."""
        block, bit = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
        bits, sums = self.bits[smaller], self.sums[smaller]
        if isinstance(c, slice):
            return sums[block, c] + np.bitwise_count(bits[block, c] & (bit - np.uint64(1))[:, None])
        return sums[block, c] + np.bitwise_count(bits[block, c] & (bit - np.uint64(1)))


class Vocabulary:
    """The index of sorted distinct words."""

    def __init__(self, words: list[str]):
        self.words = words
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.alphabet, codes = np.unique(points, return_inverse=True)
        self.sigma = len(self.alphabet) + 1
        self.text = np.zeros(len(points) + len(words) + 1, dtype=np.uint16 if self.sigma < 1 << 16 else np.uint32)
        self.text[np.arange(len(points)) + np.repeat(np.arange(1, len(words) + 1), lengths)] = codes + 1

    @cached_property
    def before(self) -> _Side:
        """Extends patterns to the left."""
        return _Side(self.text, self.sigma, len(self.words) + 1)

    @cached_property
    def behind(self) -> _Side:
        """Extends patterns to the right: the index of the reversed text."""
        return _Side(self.text[::-1], self.sigma, len(self.words) + 1)

    def _codes(self, patterns: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of the patterns one after another (-1: none of the vocabulary's),
        where each starts, and its length."""
        points = np.frombuffer("".join(patterns).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, patterns), dtype=np.int64, count=len(patterns))
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        codes = np.where(self.alphabet[at] == points, at + 1, -1)
        return np.append(codes, -1), np.cumsum(lengths) - lengths, lengths

    def one_error(self, patterns: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (pattern, word) with exactly one inserted, deleted or replaced code
        point, each pair once, that share the pattern's first half (``right``), or
        else its last; the halves are split at len // 2."""
        found = [self._together(patterns[i:i + TOGETHER], right, i) for i in range(0, len(patterns), TOGETHER)] if self.words else []
        pairs = [np.concatenate(c) for c in zip(*found)] or [np.empty(0, np.int64)] * 2
        return pairs[0], pairs[1]

    def _extend(self, side: _Side, state: tuple, c: np.ndarray, right: bool) -> tuple:
        """States (pattern, place, lo, other, size) with one symbol more, if any are left."""
        pattern, place, lo, other, size = state
        known = c >= 0
        c = np.where(known, c, 0)
        a, b = side.count(c, lo), side.count(c, lo + size)
        if right:  # the words' ranks narrow along
            other = other + side.count(c, lo + size, True) - side.count(c, lo, True)
        keep = known & (b > a)
        return tuple(x[keep] for x in (pattern, place + 1, side.starts[c] + a, other, b - a))

    def _together(self, patterns: list[str], right: bool, base: int) -> tuple[np.ndarray, np.ndarray]:
        side = self.behind if right else self.before
        codes, first, length = self._codes(patterns if right else [p[::-1] for p in patterns])
        exact = length // 2 if right else length - length // 2
        m, n = len(patterns), len(self.words) + 1
        symbol = lambda q, at: codes[np.minimum(first[q] + at, len(codes) - 1)]
        nought = np.zeros(m, dtype=np.int64)
        front = (np.arange(m), nought, nought, nought, nought + n)  # behind (before) any delimiter
        pool = tuple(np.empty(0, dtype=np.int64) for _ in range(5))
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        t = 0
        while len(front[0]) or len(pool[0]):
            q, place, lo, other, size = front
            at = np.flatnonzero(t >= exact[q])
            new = [pool]
            if len(at):
                # an error here: the symbol differs from the pattern's, so that it is the first one that does
                q, lo, other, size = q[at], lo[at], other[at], size[at]
                ended = t == length[q]
                own = np.where(ended, -1, symbol(q, t))
                every = slice(1, None)
                a, b = side.count(every, lo), side.count(every, lo + size)
                i, c = np.nonzero((b > a) & (np.arange(1, self.sigma) != own[:, None]))
                if right:
                    smaller = side.count(every, lo + size, True) - side.count(every, lo, True)
                    narrowed = other[i] + smaller[i, c]
                else:
                    narrowed = other[i]
                extended = (side.starts[c + 1] + a[i, c], narrowed, (b - a)[i, c].astype(np.int64))
                new.append((q[i], np.full(len(i), t), *extended))  # inserted
                j = ~ended[i]
                new.append((q[i][j], np.full(j.sum(), t + 1), *(x[j] for x in extended)))  # replaced
                gone = ~ended & ((t + 1 == length[q]) | (symbol(q, t + 1) != own))
                new.append((q[gone], np.full(gone.sum(), t + 1), lo[gone], other[gone], size[gone]))  # deleted
            pool = tuple(np.concatenate(x) for x in zip(*new))
            done = pool[1] == length[pool[0]]
            whole = self._extend(side, tuple(x[done] for x in pool), nought[:1].repeat(done.sum()), right)
            hits.append((whole[0] + base, whole[3] if right else whole[2]))
            pool = tuple(x[~done] for x in pool)
            pool = self._extend(side, pool, symbol(pool[0], pool[1]), right)
            front = tuple(x[t < length[front[0]]] for x in front)
            front = self._extend(side, front, symbol(front[0], t), right)
            t += 1
        return tuple(np.concatenate(c) for c in zip(*hits)) if hits else (np.empty(0, np.int64),) * 2
