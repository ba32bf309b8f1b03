"""A bidirectional FM-index over a sequence of word numbers, for phrases of limited length.

Symbol 0 separates pieces and is in no phrase. Suffixes are sorted by their first ``depth`` symbols only, which is
enough for every phrase of that length: its suffixes are one interval. All intervals of a length are extended
together, so the steps are array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their next ``depth`` symbols; zeros are taken to follow the end."""
    rank = np.concatenate([text, np.zeros(depth, dtype=np.int64)])
    width = 1
    while width < depth:
        wider = min(2 * width, depth)
        later = np.concatenate([rank[wider - width :], np.zeros(wider - width, dtype=np.int64)])
        _, rank = np.unique(rank * (int(rank.max()) + 1) + later, return_inverse=True)
        rank, width = rank.reshape(-1), wider
    return np.argsort(rank[: len(text)], kind="stable")


class OneWay:
    """Backward search over one direction: the BWT, and its rows by symbol for counting occurrences above a row."""

    def __init__(self, text: np.ndarray, depth: int):
        order = suffix_order(text, depth)
        self.rows = len(text)
        self.bwt = np.where(order > 0, text[order - 1], 0)
        self.keys = np.sort(self.bwt * self.rows + np.arange(self.rows))
        self.first = text[order]

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The LF step: the row where the suffixes with ``symbol`` before those from ``row`` on begin."""
        return np.searchsorted(self.keys, symbol * self.rows + row)

    def preceding(self, lo: np.ndarray, hi: np.ndarray, symbols: int) -> tuple[np.ndarray, ...]:
        """Every symbol that occurs before an interval: the interval, the symbol, how often, and how many occurrences there are of smaller ones."""
        size = hi - lo
        begin = np.cumsum(size) - size
        row = np.arange(int(size.sum())) + np.repeat(lo - begin, size)
        found, count = np.unique(np.repeat(np.arange(len(lo)), size) * symbols + self.bwt[row], return_counts=True)
        which, symbol = np.divmod(found, symbols)
        smaller = np.cumsum(count) - count - begin[which]
        real = symbol > 0
        return which[real], symbol[real], count[real], smaller[real]


@dataclass
class Phrases:
    """Phrases of one length with their intervals in both directions."""

    words: np.ndarray
    lo: np.ndarray
    back: np.ndarray
    count: np.ndarray


class FmIndex:
    """Both directions over ``text``, whose symbols are below ``symbols``. A break at each end keeps the BWT complete."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.text, self.symbols, self.depth = np.concatenate([[0], text, [0]]).astype(np.int64), symbols, depth
        self.ahead, self.behind = OneWay(self.text, depth), OneWay(self.text[::-1], depth)

    def single(self) -> Phrases:
        place = np.searchsorted(self.ahead.first, np.arange(1, self.symbols + 1))
        count = np.diff(place)
        seen = np.flatnonzero(count)
        return Phrases(seen[:, None] + 1, place[seen], place[seen], count[seen])

    def extend_left(self, p: Phrases) -> Phrases:
        """All phrases with one more word in front."""
        which, word, count, smaller = self.ahead.preceding(p.lo, p.lo + p.count, self.symbols)
        return Phrases(np.column_stack([word, p.words[which]]), self.ahead.before(word, p.lo[which]), p.back[which] + smaller, count)

    def extend_right(self, p: Phrases) -> Phrases:
        """All phrases with one more word behind."""
        which, word, count, smaller = self.behind.preceding(p.back, p.back + p.count, self.symbols)
        return Phrases(np.column_stack([p.words[which], word]), p.lo[which] + smaller, self.behind.before(word, p.back[which]), count)

    def phrases(self, context: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(words, counts) of all phrases of each length up to the depth, extended to the left and to the right in turn.

        Occurrences that end within the first ``context`` symbols are not counted.
        """
        level = self.single()
        for length in range(1, self.depth + 1):
            count = level.count.copy()
            for start in range(1, context - length + 2):
                count[(level.words == self.text[start : start + length]).all(axis=1)] -= 1
            yield level.words, count
            if length < self.depth:
                level = self.extend_right(level) if length % 2 else self.extend_left(level)
