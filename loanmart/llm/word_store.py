"""Ids of words, found once and kept in arrays: a word costs some thirty bytes.

Words are told apart by 64-bit hashes. When the store is full, the half that was asked for least often goes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash

LIMIT = 700_000


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places ``start .. start + size - 1`` of each run, one run after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


class WordStore:
    """``solve`` gives the ids of a list of words: how many each has, and all of them in order."""

    def __init__(self, solve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kind, limit: int = LIMIT):
        self.solve, self.limit = solve, limit
        self.values, self.used = np.zeros(0, kind), 0
        self._parts = [self._empty(), self._empty()]  # a large sorted part and a small one of recent words

    @staticmethod
    def _empty() -> list[np.ndarray]:
        return [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)]

    def _merged(self, a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
        both = [np.concatenate(pair) for pair in zip(a, b)]
        order = np.argsort(both[0], kind="stable")
        return [column[order] for column in both]

    def _append(self, ids: np.ndarray) -> int:
        at, need = self.used, self.used + len(ids)
        if need > len(self.values):
            grown = np.zeros(max(need, len(self.values) * 3 // 2), self.values.dtype)
            grown[:at] = self.values[:at]
            self.values = grown
        self.values[at:need] = ids
        self.used = need
        return at

    def _evict(self) -> None:
        old = self._merged(*self._parts)
        kept = np.sort(np.argsort(old[3], kind="stable")[len(old[3]) // 2 :])
        hashes, start, size, uses = (column[kept] for column in old)
        values = self.values[ragged(start, size.astype(np.int64))]
        self.values, self.used = values, len(values)
        self._parts = [[hashes, np.cumsum(size, dtype=np.int64) - size, size, uses // 2], self._empty()]

    def find(self, words: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``values`` the ids of each distinct word are, and how many; ``times`` says how often it is asked for."""
        if sum(len(p[0]) for p in self._parts) > self.limit:
            self._evict()
        listed = words.cast(pa.binary()).to_pylist()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed))
        start, size, known = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        for part in self._parts:
            if len(part[0]):
                at = np.minimum(np.searchsorted(part[0], hashes), len(part[0]) - 1)
                hit = part[0][at] == hashes
                start[hit], size[hit] = part[1][at[hit]], part[2][at[hit]]
                np.add.at(part[3], at[hit], times[hit])
                known |= hit
        new = np.flatnonzero(~known)
        if len(new):
            sizes, ids = self.solve([listed[i].decode() for i in new])
            size[new] = sizes
            start[new] = self._append(ids) + np.cumsum(sizes) - sizes
            fresh = [hashes[new], start[new], size[new].astype(np.int32), times[new].astype(np.int64)]
            large, recent = self._parts
            recent = self._merged(recent, fresh)
            self._parts = [self._merged(large, recent), self._empty()] if 4 * len(recent[0]) > len(large[0]) else [large, recent]
        return start, size

    def texts(self, words: pa.StringArray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as all their words in order, ``first[t]`` being the first word of text ``t`` (one more for the
        end): all ids, and where each text's begin (one more for the end)."""
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy()
        start, size = self.find(coded.dictionary, np.bincount(index, minlength=len(coded.dictionary)))
        sizes = size[index]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.values[ragged(start[index], sizes)], ends[first]
