"""A compressed FM-index over an integer text, searched for many patterns at once.

The Burrows-Wheeler transform is kept in a wavelet matrix: one bit vector per bit
of a symbol, packed into words with a running count, so that the rank of a symbol
takes a few steps whatever the text. Backward search extends patterns to the left
and finds the interval of suffixes they begin. Matching statistics give, for each
position of a streamed text, the longest match (up to ``depth`` symbols) that
starts there and where in the indexed text it first occurs.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the end of the text sorts before all symbols."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while n:
        after = np.zeros(n, np.int64)
        after[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ranked = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = ranked
        if ranked[-1] == n - 1:
            break
        step *= 2
    return order


class WaveletMatrix:
    """Rank queries over a sequence of small integers."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        row = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.frombuffer(packed.tobytes() + bytes(-len(packed) % 8 + 8), "<u8")
            self.words.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))]))
            self.zeros.append(int(len(bit) - bit.sum()))
            row = np.concatenate([row[~bit], row[bit]])
        self.starts = self._down(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The place of position ``at`` of the sequence below all bits of the symbol."""
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            mask = (np.uint64(1) << bit) - np.uint64(1)
            ones = self.before[i][word] + np.bitwise_count(self.words[i][word] & mask)
            at = np.where(symbol >> level & 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._down(symbol, at) - self.starts[symbol]


class FMIndex:
    """Index of ``text`` (symbols below ``n_symbols``) for matches of at most ``depth`` symbols."""

    def __init__(self, text: np.ndarray, n_symbols: int, depth: int):
        self.n, self.depth = len(text), depth
        order = suffix_array(text)
        # row 0 is the empty suffix; the symbol before the whole text is the end mark 0, symbols count from 1
        rows = np.concatenate([[self.n], order])
        marked = np.concatenate([[0], text + 1])
        self.wavelet = WaveletMatrix(marked[rows], n_symbols + 1)
        counts = np.bincount(marked, minlength=n_symbols + 1)
        self.below = np.cumsum(counts) - counts
        padded = np.concatenate([text, np.full(depth, -1)])
        same, common = np.ones(self.n, bool), np.zeros(self.n + 1, np.int64)
        for j in range(depth):  # common prefix of neighbouring suffixes, up to depth
            here = padded[rows[1:] + j]
            same &= (here == padded[np.minimum(rows[:-1] + j, self.n + depth - 1)]) & (here >= 0)
            common[1:] += same
        common[0] = -1  # the first row begins an interval at any length
        self.common = common
        self._bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        starts = np.flatnonzero(common < depth)
        self.first = np.minimum.reduceat(rows, starts)  # of each class of suffixes equal to ``depth``
        self.class_of = np.cumsum(common < depth) - 1

    def bounds(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row the interval of rows that share its first ``length`` symbols."""
        if length not in self._bounds:
            cut = self.common < length
            starts = np.flatnonzero(cut)
            which = np.cumsum(cut) - 1
            self._bounds[length] = starts[which], np.append(starts[1:], self.n + 1)[which]
        return self._bounds[length]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one more symbol at their left."""
        return (self.below[symbol + 1] + self.wavelet.rank(symbol + 1, low),
                self.below[symbol + 1] + self.wavelet.rank(symbol + 1, high))

    def matching_statistics(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray
                            ) -> tuple[np.ndarray, np.ndarray]:
        """Of every position of the streamed texts: the longest match from there, at most ``depth``, and its row.

        Texts lie one after the other in ``symbols``; symbols below 0 occur nowhere
        in the index. All texts advance together, from their ends to their starts.
        """
        match, row = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
        m = len(starts)
        low, high, size = np.zeros(m, np.int64), np.full(m, self.n + 1), np.zeros(m, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero(lengths >= back)
            at = starts[live] + lengths[live] - back
            symbol = symbols[at]
            lost = live[symbol < 0]
            low[lost], high[lost], size[lost] = 0, self.n + 1, 0
            todo, symbol = live[symbol >= 0], symbol[symbol >= 0]
            while len(todo):
                a, b = self.extend(symbol, low[todo], high[todo])
                found = a < b
                done = todo[found]
                low[done], high[done] = a[found], b[found]
                size[done] += 1
                todo, symbol = todo[~found], symbol[~found]
                none = size[todo] == 0  # the symbol alone is not in the index
                todo, symbol = todo[~none], symbol[~none]
                self._shorten(todo, size[todo] - 1, low, high, size)
            self._shorten(live[size[live] > self.depth], self.depth, low, high, size)
            match[at], row[at] = size[live], low[live]
        return match, row

    def _shorten(self, which: np.ndarray, to: np.ndarray | int, low: np.ndarray, high: np.ndarray,
                 size: np.ndarray) -> None:
        """Drops symbols at the right of patterns: their intervals widen."""
        to = np.broadcast_to(to, which.shape)
        for length in np.unique(to):
            some = which[to == length]
            left, right = self.bounds(int(length))
            high[some] = right[low[some]]
            low[some] = left[low[some]]
            size[some] = length
