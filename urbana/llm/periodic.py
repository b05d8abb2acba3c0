"""Runs of repeated words by internal pattern matching.

A run is a stretch of words with smallest period ``q``, at least ``max(24, 3 q)`` words long, that no neighbour extends. The words of many
texts stand in one array, so that each step below is one numpy operation for all of them; a text's words are its own symbols,
so nothing is found across texts.

Prefix doubling gives the classes of all windows of 1, 2, 4, ... words and in the end the suffix array, in which each class is a range; a
wavelet matrix over it answers range successor queries. For every power of two ``B`` from 8 on, each block ``[b, b + B)`` with ``B | b`` asks for
the next places of its class in the neighbouring windows ``(b, b + B]`` and ``(b + B, b + 2 B)``. Let a run have period ``q``, and ``B`` be the largest
power of two that is at most ``max(q, 8)``. The run holds a block that comes again ``q`` words on, still inside the run. Where ``q <= B`` the next
place is that one. Else it is in one of the windows, whose places are one or two, or form a progression with a difference ``p`` of
at most ``B / 2``. All of a progression then lies in one stretch of period ``p``, and so does the block; the run cuts the block's stretch on
one side at least, and the other stretch is cut alike ``q`` words on. So ``q`` is the distance of the beginnings or of the ends of the stretches.
Every candidate is extended both ways by common prefixes, looked up in the classes, and kept if it is long enough; of equal
stretches the smallest period stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from urbana.llm.arrow import with_columns

LEAST = 24  # words of a run
FIRST = 3  # blocks of 2^3 words and more
TOGETHER = 1 << 17  # words of one round, or one longer text


class Classes:
    """For each level k the class of every window of 2^k symbols: how many suffixes come before those that begin with it."""

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        there = symbols[order]
        new = np.concatenate([[True], there[1:] != there[:-1]])
        rank = np.full(n + 1, -1, np.int32)  # what lies beyond the end is no symbol
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.suffixes, self.levels, self.repeated = order.astype(np.int32), [rank], []
        open_ = order[~(new & np.append(new[1:], True))]
        while len(open_):
            self.repeated.append(open_)
            step = 1 << (len(self.levels) - 1)
            own = rank[open_].astype(np.int64)
            by = np.argsort(own * (n + 1) + rank[np.minimum(open_ + step, n)] + 1, kind="stable")
            open_, own = open_[by], own[by]
            further = rank[np.minimum(open_ + step, n)]
            place = np.arange(len(open_))
            old = np.concatenate([[True], own[1:] != own[:-1]])
            new = old | np.concatenate([[True], further[1:] != further[:-1]])
            within = place - np.maximum.accumulate(np.where(old, place, 0))
            self.suffixes[own + within] = open_
            rank = rank.copy()
            rank[open_] = own + np.maximum.accumulate(np.where(new, place, 0)) - (place - within)
            self.levels.append(rank)
            open_ = open_[~(new & np.append(new[1:], True))]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and ``j > i`` on are equal."""
        i, j = i.copy(), j.copy()
        first = i.copy()
        for k in reversed(range(len(self.repeated))):
            same = (self.levels[k][np.minimum(i, self.n)] == self.levels[k][np.minimum(j, self.n)]) & (j < self.n)
            i += same << k
            j += same << k
        return i - first

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before ``i`` and ``j > i`` are equal."""
        i, j = i.copy(), j.copy()
        first = i.copy()
        for k in reversed(range(len(self.repeated))):
            same = i >= 1 << k
            same &= self.levels[k][np.maximum(i - (1 << k), 0)] == self.levels[k][np.maximum(j - (1 << k), 0)]
            i -= same << k
            j -= same << k
        return first - i


class Wavelet:
    """A wavelet matrix over numbers; ``below`` and ``nth`` together are the range successor."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(values.max(initial=0)).bit_length(), 1)
        self.levels: list[tuple[np.ndarray, int]] = []
        for b in reversed(range(self.bits)):
            zero = values >> b & 1 == 0
            before = np.concatenate([[0], np.cumsum(zero)])
            self.levels.append((before, int(before[-1])))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values from ``low`` to before ``high`` are less than ``x``."""
        every, beyond = high - low, x >> self.bits > 0
        found = np.zeros_like(low)
        for (before, zeros), b in zip(self.levels, reversed(range(self.bits)), strict=True):
            one = (x >> b & 1).astype(bool)
            l0, h0 = before[low], before[high]
            found += np.where(one, h0 - l0, 0)
            low, high = np.where(one, zeros + low - l0, l0), np.where(one, zeros + high - h0, h0)
        return np.where(beyond, every, found)

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value with ``n`` lesser ones among those from ``low`` to before ``high``."""
        found = np.zeros_like(low)
        for (before, zeros), b in zip(self.levels, reversed(range(self.bits)), strict=True):
            l0, h0 = before[low], before[high]
            one = n >= h0 - l0
            n = np.where(one, n - (h0 - l0), n)
            found |= one.astype(found.dtype) << b
            low, high = np.where(one, zeros + low - l0, l0), np.where(one, zeros + high - h0, h0)
        return found


def candidates(classes: Classes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods that hold every run's period at a place inside it."""
    if len(classes.repeated) <= FIRST:
        return
    # Only suffixes that begin with a repeated block of the least size can answer.
    open_ = np.zeros(classes.n + 1, bool)
    open_[classes.levels[FIRST][classes.repeated[FIRST]]] = True  # classes
    kept = open_[classes.levels[FIRST][classes.suffixes]]
    before = np.concatenate([[0], np.cumsum(kept)])
    tree = Wavelet(classes.suffixes[kept].astype(np.int64))
    for k in range(FIRST, len(classes.repeated)):
        size = 1 << k
        b = classes.repeated[k][classes.repeated[k] & (size - 1) == 0].astype(np.int64)
        if not len(b):
            continue
        rank = classes.levels[k]
        many = np.bincount(rank[classes.repeated[k]], minlength=classes.n)
        low, high = before[rank[b]], before[rank[b] + many[rank[b]]]
        cuts = [tree.below(low, high, b + d) for d in (1, size + 1, 2 * size)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            there = end > start
            place, lo, hi, at, n = b[there], low[there], high[there], start[there], (end - start)[there]
            first = tree.nth(lo, hi, at)
            yield place, first - place
            two = n > 1
            place, first, n = place[two], first[two], n[two]
            second = tree.nth(lo[two], hi[two], at[two] + 1)
            yield place, second - place
            more = n > 2
            place, first, step = place[more], first[more], (second - first)[more]
            ends = classes.ahead(first, first + step) - classes.ahead(place, place + step)
            starts = classes.behind(place, place + step) - classes.behind(first, first + step)
            for shift in (ends, starts):
                period = first + shift - place
                ok = period > 0
                yield place[ok], period[ok]


def runs(symbols: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows ``(start, length, period)`` by start, then period. Symbols of one text must not occur in another."""
    classes = Classes(symbols)
    found = [np.zeros((0, 3), np.int64)]
    for place, period in candidates(classes):
        inside = place + period < classes.n
        place, period = place[inside], period[inside]
        start = place - classes.behind(place, place + period)
        length = place + period + classes.ahead(place, place + period) - start
        ok = length >= np.maximum(least, 3 * period)
        found.append(np.stack([start, length, period], axis=1)[ok])
    every = np.unique(np.concatenate(found), axis=0)
    if not len(every):
        return every
    same = (every[1:, :2] == every[:-1, :2]).all(axis=1)  # of one stretch the smallest period comes first
    every = every[np.concatenate([[True], ~same])]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def runs_of_texts(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, several texts at a time."""
    out: list[list[tuple[int, int, int]]] = []
    lo = 0
    while lo < len(words):
        hi, total = lo + 1, len(words[lo])
        while hi < len(words) and total + len(words[hi]) <= TOGETHER:
            total += len(words[hi])
            hi += 1
        symbols: list[int] = []
        starts, own = [], 0
        for text in words[lo:hi]:
            known: dict[bytes, int] = {}
            starts.append(len(symbols))
            symbols += [known.setdefault(w, own + len(known)) for w in text]
            own += len(known)
        got: list[list[tuple[int, int, int]]] = [[] for _ in starts]
        if len(symbols) >= LEAST:
            found = runs(np.array(symbols, np.int64))
            of = np.searchsorted(np.array(starts), found[:, 0], "right") - 1
            for d, (start, length, period) in zip(of.tolist(), found.tolist(), strict=True):
                got[d].append((start - starts[d], length, period))
        out += got
        lo = hi
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words outside the repetitions of every run, joined by a space: a run keeps its first ``period`` words."""
    if not found:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g])


def with_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``runs`` (array of start, length and period, by start, then period) and ``collapsed``, the text without repetitions;
    these replace columns of the names.

    Null and empty texts have no runs and collapse to the empty string. Repeated rows stay; an empty table gives an empty result. Texts are
    read whole: a task needs about 200 bytes a word of the longest text, and up to twice that where most of it is repeated.
    """

    def compute(rows: list[bytes]) -> list[pa.Array]:
        words = [t.split() for t in rows]
        found = runs_of_texts(words)
        flat = np.array([r for f in found for r in f], np.int64).reshape(-1, 3)
        each = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32))
        texts = pa.array([collapsed(w, f).decode("utf-8", "replace") for w, f in zip(words, found, strict=True)], pa.string())
        return [pa.ListArray.from_arrays(offsets, each), texts]

    return with_columns(docs, text, "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string", compute, keep)
