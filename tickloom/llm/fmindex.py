"""A bidirectional FM-index over numbers: intervals grow to either side by one symbol."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np


class Found(NamedTuple):
    """Phrases of one length: row i of ``words`` stands ``count[i]`` times in the text.

    ``low`` and ``low_back`` start its intervals in the index of the text and of the reversed text.
    """

    words: np.ndarray
    count: np.ndarray
    low: np.ndarray
    low_back: np.ndarray


def _sorted_suffixes(text: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Places of the text in order of the ``depth`` symbols that start there; 0 fills the end."""
    bits = int(symbols).bit_length()
    key, used = text.astype(np.int64), bits
    for ahead in range(1, depth):
        if used + bits > 63:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            used = int(len(text)).bit_length()
        following = np.zeros_like(key)
        following[: len(text) - ahead] = text[ahead:]
        key, used = (key << bits) | following, used + bits
    return np.argsort(key)


class _Direction:
    """Burrows-Wheeler transform of a text whose suffixes are in order up to a depth."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.before = text[_sorted_suffixes(text, symbols, depth) - 1]
        # where the suffix that starts one symbol earlier stands: symbols keep their order
        self.last_to_first = np.empty(len(text), np.int32)
        self.last_to_first[np.argsort(self.before, kind="stable")] = np.arange(len(text), dtype=np.int32)


class BidirectionalIndex:
    """``text`` holds numbers below ``symbols``; 0 ends a piece, and starts and ends the text."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.symbols = symbols
        self.counts = np.bincount(text, minlength=symbols)
        self.starts = np.cumsum(self.counts) - self.counts
        self.forward = _Direction(text, symbols, depth)
        self.back = _Direction(text[::-1], symbols, depth)

    def single(self) -> Found:
        words = np.flatnonzero(self.counts[1:]) + 1
        return Found(words[:, None], self.counts[words], self.starts[words], self.starts[words])

    def _grown(self, side: _Direction, low: np.ndarray, other: np.ndarray, count: np.ndarray):
        """All symbols next to the intervals ``low`` of one direction.

        (interval, symbol, count, low here, low in the other direction) per pair that occurs. The
        new interval here follows from the last-to-first map; in the other direction it lies in the old
        one, behind all occurrences with a smaller symbol.
        """
        owner = np.repeat(np.arange(len(low)), count)
        first = np.cumsum(count) - count
        place = np.arange(len(owner)) - first[owner] + low[owner]
        key = owner * self.symbols + side.before[place]
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.append(begin, len(key)))
        of, symbol = np.divmod(key[begin], self.symbols)
        inner = side.last_to_first[place[order[begin]]].astype(np.int64)
        outer = other[of] + begin - first[of]
        keep = symbol > 0
        return of[keep], symbol[keep], times[keep], inner[keep], outer[keep]

    def left(self, found: Found) -> Found:
        """Every phrase with every symbol that precedes it."""
        of, symbol, times, low, low_back = self._grown(self.forward, found.low, found.low_back, found.count)
        return Found(np.concatenate([symbol[:, None], found.words[of]], axis=1), times, low, low_back)

    def right(self, found: Found) -> Found:
        """Every phrase with every symbol that follows it."""
        of, symbol, times, low_back, low = self._grown(self.back, found.low_back, found.low, found.count)
        return Found(np.concatenate([found.words[of], symbol[:, None]], axis=1), times, low, low_back)

    def phrases(self, longest: int) -> Iterator[Found]:
        """All phrases of one symbol, of two, and so on, extended to the left and right in turn."""
        found = self.single()
        for size in range(1, longest + 1):
            yield found
            if size < longest:
                found = self.left(found) if size % 2 else self.right(found)
