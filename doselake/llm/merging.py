"""Merging of neighbouring symbols in rounds, over one flat array of many words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

NONE = np.int32(2**31 - 1)


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in sorted ``keys``, whether it is there) of each wanted one."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all spans, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def alternate(at: np.ndarray) -> np.ndarray:
    """Of places in ascending order the 1st, 3rd, ... of every run of neighbours."""
    if not len(at):
        return at
    new = np.concatenate([[True], np.diff(at) != 1])
    order = np.arange(len(at))
    return at[(order - np.maximum.accumulate(np.where(new, order, 0))) % 2 == 0]


@dataclass
class Merges:
    """Which pairs of symbols merge, into what, and which first."""

    pairs: np.ndarray  # left * 2^32 + right, sorted
    merged: np.ndarray  # symbol that a pair becomes
    ranks: np.ndarray  # of each pair, the least goes first

    @classmethod
    def of(cls, table: dict[int, tuple[int, int]]) -> Merges:
        """From {left * 2^32 + right: (symbol, rank)}."""
        keys = np.array(sorted(table), np.int64)
        made = [table[k] for k in keys.tolist()]
        return cls(keys, np.array([m for m, _ in made], np.int64), np.array([r for _, r in made], np.int32))

    def joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, rank) each pair becomes; rank NONE if it does not merge."""
        if not len(self.pairs):
            return np.zeros(len(left), np.int64), np.full(len(left), NONE)
        at, there = found(self.pairs, (left << 32) + right)
        return self.merged[at], np.where(there, self.ranks[at], NONE)

    def rounds(self, symbol: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Merge within the segments that ``opens`` starts; ``symbol`` is written to. Places of the symbols left."""
        left = []
        place = np.arange(len(symbol))
        segment = np.cumsum(opens)
        made = np.zeros(len(symbol), np.int64)
        rank = np.full(len(symbol), NONE)
        within = np.flatnonzero(segment[:-1] == segment[1:])
        made[within], rank[within] = self.joined(symbol[within], symbol[within + 1])
        now = symbol
        while len(place):
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sizes = np.diff(np.append(starts, len(place)))
            least = np.minimum.reduceat(rank, starts)
            ended = np.repeat(least == NONE, sizes)
            if ended.any():
                symbol[place[ended]] = now[ended]
                left.append(place[ended])
                open_ = ~ended
                place, segment, now, made, rank = (x[open_] for x in (place, segment, now, made, rank))
                least, sizes = least[least != NONE], sizes[least != NONE]
                if not len(place):
                    break
            at = alternate(np.flatnonzero(rank == np.repeat(least, sizes)))
            at = at[~self.hasty(at, now, made, rank, segment)]
            keep = np.ones(len(place), bool)
            keep[at + 1] = False
            now[at] = made[at]
            place, segment, now, made, rank = (x[keep] for x in (place, segment, now, made, rank))
            at -= np.arange(len(at))
            fresh = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[fresh] = NONE
            fresh = fresh[fresh + 1 < len(place)]
            fresh = fresh[segment[fresh] == segment[fresh + 1]]
            made[fresh], rank[fresh] = self.joined(now[fresh], now[fresh + 1])
        return np.sort(np.concatenate(left)) if left else np.empty(0, np.int64)

    def hasty(self, at, now, made, rank, segment) -> np.ndarray:
        """Which of the merges must wait: all but the first where one makes a pair that ranks before the next."""
        sign, level = made[at], rank[at]
        early = np.zeros(len(at), bool)
        before = at - 1
        inside = np.flatnonzero((at > 0) & (segment[before] == segment[at]))
        neighbour = now[before[inside]]
        # the neighbour may have been merged just before
        follows = np.flatnonzero((inside > 0) & (at[inside - 1] + 1 == before[inside]))
        neighbour[follows] = sign[inside[follows] - 1]
        early[inside] |= self.joined(neighbour, sign[inside])[1] <= level[inside]
        after = np.minimum(at + 2, len(now) - 1)
        inside = np.flatnonzero((at + 2 < len(now)) & (segment[after] == segment[at]))
        early[inside] |= self.joined(sign[inside], now[after[inside]])[1] <= level[inside]
        if not early.any():
            return early
        held = np.isin(segment[at], segment[at[early]])
        first = np.concatenate([[True], segment[at[1:]] != segment[at[:-1]]])
        return held & ~first


class Known(dict):
    """Numbers words in the order they come, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Memory:
    """Ids of the words a worker has seen, within bounds of number and room."""

    def __init__(self, words: int, room: int):
        self.words, self.room = words, room
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        self.ids = np.empty(1 << 12, np.int32)
        self.starts = np.zeros(1 << 10, np.int64)
        self.sizes = np.zeros(1 << 10, np.int64)
        self.used = self.letters = 0

    def full(self) -> bool:
        return len(self.known) > self.words or self.letters + self.used > self.room

    def add(self, ids: np.ndarray, sizes: np.ndarray, letters: int) -> None:
        """Ids of the words that ``known`` lists as new."""
        self.known.new = []
        total = len(self.known)
        while total > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.sizes[total - len(sizes) : total] = sizes
        self.starts[total - len(sizes) : total] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.letters += letters

    def gather(self, numbers: np.ndarray, counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of words, one after the other; ids of each row), ``counts`` words a row."""
        sizes = self.sizes[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *counts])]
        return self.ids[spans(self.starts[numbers], sizes)], np.diff(ends)


def strings(data: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Strings or binaries of so many bytes each, lying one after the other in ``data``."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
