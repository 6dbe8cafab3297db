"""Encoding of many texts by units that are encoded alone, each distinct unit once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from fathom.llm._text import span_hashes

Split = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # code points; start, end and text number of each unit


class UnitMemo:
    """Ids by unit in a direct-mapped table, which is emptied when it holds ``most`` units. Subclasses give ``split``
    (texts to units) and ``unit`` (ids of one unit)."""

    split: Callable[[list[str]], Split]
    unit: Callable[[str], list[int]]

    def __init__(self, most: int = 300_000):
        self.most, self.bits = most, max(10, most.bit_length())  # a place or two for each unit
        self.clear()

    def clear(self) -> None:
        self.key, self.row = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.begin, self.count, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32), 0
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0

    def _learn(self, units: list[str]) -> np.ndarray:
        lists = [self.unit(u) for u in units]
        count = np.fromiter(map(len, lists), np.int32, len(lists))
        ids = np.fromiter((i for x in lists for i in x), np.uint32, int(count.sum()))
        while self.n + len(units) > len(self.begin):
            self.begin, self.count = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.count, 2 * len(self.count))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.begin[self.n : self.n + len(units)] = self.used + np.cumsum(count) - count
        self.count[self.n : self.n + len(units)] = count
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.n += len(units)
        return np.arange(self.n - len(units), self.n, dtype=np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        cp, starts, ends, doc = self.split(texts)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if self.n > self.most:
            self.clear()
        h = span_hashes(cp, starts, ends) | np.uint64(1)  # never the 0 of an empty slot
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        row = self.row[slot]
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            keys, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            at = miss[first]
            joined = cp.tobytes()
            rows = self._learn([joined[4 * x : 4 * y].decode("utf-32-le", "surrogatepass") for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            row[miss] = rows[back]
            self.key[slot[at]], self.row[slot[at]] = keys, rows
        count = self.count[row].astype(np.int64)
        upto = np.cumsum(count)
        place = np.repeat(self.begin[row] - (upto - count), count)
        place += np.arange(upto[-1])
        return self.flat[place], np.bincount(doc, weights=count, minlength=len(texts)).astype(np.int64)
