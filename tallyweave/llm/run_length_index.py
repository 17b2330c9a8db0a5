"""Run-length index of a shard: its Burrows-Wheeler transform by runs, with suffixes sampled at run ends.

Where two neighbouring rows of the transform carry the same symbol, the suffixes one symbol longer are
neighbours too and match one symbol more.  So the matches of all positions follow from those at the ends
of runs: streaming through the text, the longest match of a position is that of the nearest sampled
position before it, less the distance.  A repetitive shard has few runs and so few samples.
"""

import numpy as np

_HEAD = 7  # symbols of nine bits that fit a 64-bit key


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 1 of the keys."""
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.empty(len(keys), np.int32)  # a shard has far fewer than 2^31 symbols
    ranks[order] = np.concatenate(([1], 1 + np.cumsum(ordered[1:] != ordered[:-1])))
    return ranks


class RunLengthIndex:
    """Index over texts that end each at a mark of its own: a match never runs across the end of a text."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) + 1 for t in texts])
        self.starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
        joined[self.starts + sizes - 1] = 0
        self.symbols = joined
        self.left = np.repeat(self.starts + sizes - 1, sizes) - np.arange(len(joined))
        self.levels = self._sorted_prefixes()
        order = np.argsort(self.levels[-1], kind="stable")
        self._sample_run_ends(order)

    def _sorted_prefixes(self) -> list[np.ndarray]:
        """Ranks of all positions by their first 7, 14, 28, ... symbols."""
        n, longest = len(self.symbols), int(self.left.max(initial=0))
        padded = np.concatenate((self.symbols, np.zeros(_HEAD, np.int64)))
        key = np.zeros(n, np.int64)
        for place in range(_HEAD):
            key = (key << 9) | np.where(self.left > place, padded[place : place + n], 0)
        levels = [_ranks(key)]
        width = _HEAD
        while width < longest:
            rank = levels[-1]
            after = np.zeros(n, np.int64)
            inside = np.flatnonzero(self.left[: max(n - width, 0)] > width)
            after[inside] = rank[inside + width]
            levels.append(_ranks(rank.astype(np.int64) * (n + 1) + after))
            width *= 2
        return levels

    def _sample_run_ends(self, order: np.ndarray) -> None:
        before = self.symbols[order - 1]  # of a text's first symbol: an end mark, a run of its own
        new = (before[1:] != before[:-1]) | (before[1:] == 0)
        heads = np.flatnonzero(new) + 1
        self.runs = len(heads) + 1
        self.run_heads = order[heads]
        self.run_tails = order[heads - 1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of the suffixes at a and at b."""
        most = np.minimum(self.left[a], self.left[b])
        length = np.zeros(len(a), np.int64)
        last = len(self.symbols) - 1
        for level in range(len(self.levels) - 1, -1, -1):
            width = _HEAD << level
            rank = self.levels[level]
            at, to = np.minimum(a + length, last), np.minimum(b + length, last)
            length += np.where((length + width <= most) & (rank[at] == rank[to]), width, 0)
        for _ in range(_HEAD):
            at, to = np.minimum(a + length, last), np.minimum(b + length, last)
            length += (length < most) & (self.symbols[at] == self.symbols[to])
        return length

    def repeats(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the maximal runs of symbols in strings of ``least`` that start twice."""
        length = self.common(self.run_heads, self.run_tails)
        long = length >= least
        reach = np.zeros(len(self.symbols), np.int64)
        for sampled in (self.run_heads[long], self.run_tails[long]):
            np.maximum.at(reach, sampled, sampled + length[long])
        # Matching statistics, streamed: a match goes on to where it ends.
        covered = np.maximum.accumulate(reach) > np.arange(len(reach))
        edges = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
        return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
