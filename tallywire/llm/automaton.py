"""Suffix automaton of several word sequences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np


class SuffixAutomaton:
    """Generalised suffix automaton: every word range of every sequence is a path from state 0.

    States and transitions are at most a small multiple of the words put in, so the
    size follows from that number, which callers bound before they build one.
    """

    def __init__(self, sequences: Iterable[Sequence[int]]):
        self.length, self.link, self.next = [0], [-1], [{}]
        # Per state, the place (sequence, words up to its end) at which it first ended.
        self.place: list[tuple[int, int]] = [(-1, 0)]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word, (number, at + 1))

    def _state(self, length: int, link: int, following: dict, place: tuple[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        self.place.append(place)
        return len(self.length) - 1

    def _split(self, before: int, word: int) -> int:
        """The state for exactly the paths through ``before`` and ``word``."""
        target = self.next[before][word]
        if self.length[target] == self.length[before] + 1:
            return target
        copy = self._state(self.length[before] + 1, self.link[target],
                           dict(self.next[target]), self.place[target])
        self.link[target] = copy
        while before >= 0 and self.next[before].get(word) == target:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int, place: tuple[int, int]) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        added = self._state(self.length[last] + 1, 0, {}, place)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = added
            last = self.link[last]
        if last >= 0:
            self.link[added] = self._split(last, word)
        return added

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """State and length of the longest match that ends with ``word``."""
        following = self.next
        while word not in following[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            matched = self.length[state]
        return following[state][word], matched + 1

    def shortened(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def by_length(self) -> list[int]:
        return sorted(range(1, len(self.length)), key=self.length.__getitem__)


class Alphabet:
    """Numbers for the words of an automaton, looked up by their 64-bit hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word; -1 if it isn't among them."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, -1)


def known_runs(ids: np.ndarray, offsets: np.ndarray, least: int):
    """(row, first, end) of the runs of at least ``least`` known words, within rows."""
    known = ids >= 0
    edge = np.zeros(len(ids) + 1, bool)
    edge[offsets] = True
    first, end = known.copy(), known.copy()
    first[1:] &= ~known[:-1] | edge[1:-1]
    end[:-1] &= ~known[1:] | edge[1:-1]
    first, end = np.flatnonzero(first), np.flatnonzero(end) + 1
    long = end - first >= least
    first, end = first[long], end[long]
    rows = np.searchsorted(offsets, first, "right") - 1
    return zip(rows.tolist(), first.tolist(), end.tolist())
