"""FM-index over a sequence of integer symbols: wavelet-tree ranks and sampled suffix positions."""

import numpy as np

SAMPLE = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a text of symbols from 0 up, by prefix doubling.

    The last symbol must be the only 0, which ends every comparison.
    """
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        width *= 2
        if width >= n or rank[order[-1]] == n - 1:
            return order


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector a level, each symbol's bits from the top down."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = sequence
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(int(len(bit) - bit.sum()))
            # Zeros first, order kept: the next level of every node in one array.
            current = np.concatenate((current[bit == 0], current[bit == 1]))

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        begin, end = np.zeros_like(position), position
        for depth, ones in enumerate(self.ones):
            one = ((symbol >> (self.levels - 1 - depth)) & 1).astype(bool)
            begin = np.where(one, self.zeros[depth] + ones[begin], begin - ones[begin])
            end = np.where(one, self.zeros[depth] + ones[end], end - ones[end])
        return end - begin

    def access(self, position: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        symbol = np.zeros_like(position)
        for depth, ones in enumerate(self.ones):
            one = ones[position + 1] > ones[position]
            symbol = 2 * symbol + one
            position = np.where(one, self.zeros[depth] + ones[position], position - ones[position])
        return symbol


class FMIndex:
    """Counts and positions of patterns in a text whose symbols are 1 and up."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        text = np.concatenate((text.astype(np.int64), [0]))
        order = suffix_array(text)
        bwt = text[order - 1]  # the symbol before the first one is the end mark
        self.tree = WaveletTree(bwt, symbols + 1)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        sampled = order % sample == 0
        self.sampled = np.concatenate(([0], np.cumsum(sampled)))
        self.positions = order[sampled]
        self.length = len(text)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of patterns, given as rows that end at the last column."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.length)
        for back in range(1, patterns.shape[1] + 1):
            alive = np.flatnonzero((lengths >= back) & (low < high))
            symbol = patterns[alive, -back]
            low[alive] = self.before[symbol] + self.tree.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.tree.rank(symbol, high[alive])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back to the nearest sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        out = np.full(len(rows), -1, np.int64)
        open_rows = np.arange(len(rows))
        while len(open_rows):
            at = rows[open_rows]
            hit = self.sampled[at + 1] > self.sampled[at]
            done = open_rows[hit]
            out[done] = self.positions[self.sampled[rows[done]]] + steps[done]
            open_rows = open_rows[~hit]
            symbol = self.tree.access(rows[open_rows])
            rows[open_rows] = self.before[symbol] + self.tree.rank(symbol, rows[open_rows])
            steps[open_rows] += 1
        return out
