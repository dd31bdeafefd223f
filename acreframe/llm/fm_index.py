"""FM-index of a shard of word ids: suffix array, wavelet-matrix ranks, backward search and locating by sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of the suffixes of seq, whose zeros are separators: each counts as a symbol of its own, in order of position.

    Prefix doubling from three symbols on that sorts again only the suffixes whose group isn't settled; comparisons end at a
    separator, so the last element must be one.
    """
    n = len(seq)
    gaps = np.flatnonzero(seq == 0)
    rank = seq.astype(np.int64) + len(gaps)
    rank[gaps] = np.arange(len(gaps))
    base = int(rank.max(initial=0)) + 1
    h = 3 if base < 1 << 20 else 1
    keys = rank
    for k in range(1, h):
        keys = keys * base + np.concatenate((rank[k:], np.zeros(min(k, n), np.int64)))[:n]
    sa = np.argsort(keys, kind="stable")
    live, keys = sa.copy(), keys[sa]
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    group_at = np.arange(n)
    while True:
        # live: suffixes in order; first: where a new group starts; group_at: the slot in sa of each.
        starts = np.flatnonzero(first)
        many = np.diff(np.append(starts, len(live)))
        head, more = np.repeat(group_at[starts], many), np.repeat(many > 1, many)
        rank[live] = head
        if not more.any():
            return sa
        live, group_at, head = live[more], group_at[more], head[more]
        then = rank[live + h]
        h *= 2
        again = np.lexsort((then, head))
        live, then, head = live[again], then[again], head[again]
        sa[group_at] = live
        first = np.concatenate(([True], (head[1:] != head[:-1]) | (then[1:] != then[:-1])))


class WaveletMatrix:
    """Ranks of every symbol at every position, for arrays of queries at a time."""

    def __init__(self, seq: np.ndarray, top: int) -> None:
        self.bits = max(1, int(top).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (seq >> level) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        begin = np.zeros_like(at)
        for ones, zeros, level in zip(self.ones, self.zeros, range(self.bits - 1, -1, -1), strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = ones[at], ones[begin]
            at = np.where(one, zeros + a, at - a)
            begin = np.where(one, zeros + b, begin - b)
        return at - begin


class FMIndex:
    """seq: word ids from 1, each run of words closed by a zero."""

    def __init__(self, seq: np.ndarray, every: int = 16) -> None:
        self.n, self.top = len(seq), int(seq.max(initial=0))
        sa = suffix_array(seq)
        self.bwt = seq[sa - 1]
        self.ranks = WaveletMatrix(self.bwt, self.top)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=self.top + 1))))
        # Sampled: every so many positions, and each start of a run, so that no walk passes a separator.
        sampled = (sa % every == 0) | (self.bwt == 0)
        self.before = np.concatenate(([0], np.cumsum(sampled)))
        self.sampled, self.samples = sampled, sa[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of the rows of phrases, all of one length: the range of suffixes that begin with each."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.flatnonzero((phrases <= self.top).all(axis=1))
        hi[(phrases > self.top).any(axis=1)] = 0
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, k].astype(np.int64)
            lo[live] = self.less[symbol] + self.ranks.rank(symbol, lo[live])
            hi[live] = self.less[symbol] + self.ranks.rank(symbol, hi[live])
            live = live[hi[live] > lo[live]]
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in seq of suffixes, by walks back to sampled ones."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        live = np.flatnonzero(~self.sampled[at])
        while len(live):
            symbol = self.bwt[at[live]].astype(np.int64)
            at[live] = self.less[symbol] + self.ranks.rank(symbol, at[live])
            steps[live] += 1
            live = live[~self.sampled[at[live]]]
        return self.samples[self.before[at]] + steps
