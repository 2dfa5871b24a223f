"""FM-index of one shard of symbols: suffix order, wavelet matrix, samples.

Symbols are small integers; 0 separates and never occurs in a pattern, and no
suffix comparison passes a separator.  Everything is numpy: patterns are
searched, and occurrences walked back to sampled positions, many at a time.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16  # every so many text positions keep their place in the suffix order


class Bits:
    """A bit array with constant-time rank, one 64-bit word at a time."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, each compared up to its separator; ties of separators by place.

    Prefix doubling that sorts again only what is still tied, so that long
    copies inside a shard cost rounds for themselves alone.
    """
    n = len(text)
    keys = text.astype(np.int64) + n
    ends = np.flatnonzero(text == 0)
    keys[ends] = np.arange(len(ends))
    order = np.argsort(keys, kind="stable")
    first = _first_of_run(keys[order])
    rank = np.empty(n, dtype=np.int64)  # place of the first suffix that is equal so far
    rank[order] = first
    tied = _tied(first)
    depth = 1
    while len(tied):
        at = order[tied]
        both = rank[at] * (n + 1) + rank[at + depth]
        move = np.argsort(both, kind="stable")
        at, both = at[move], both[move]
        order[tied] = at
        first = tied[_first_of_run(both)]
        # places of a group are consecutive, so the first place of an equal run is its new rank
        rank[at] = first
        tied = tied[_tied(first)]
        depth *= 2
    return order


def _first_of_run(sorted_keys: np.ndarray) -> np.ndarray:
    """For each place, the first place that holds the same key."""
    new = np.ones(len(sorted_keys), dtype=bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, dtype=np.int64)


def _tied(first: np.ndarray) -> np.ndarray:
    same = np.zeros(len(first) + 1, dtype=bool)
    same[1:-1] = first[1:] == first[:-1]
    return np.flatnonzero(same[1:] | same[:-1])


class FMIndex:
    """``text`` ends with a separator and holds symbols below ``sigma``."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = self.n = len(text)
        order = suffix_order(text)
        last = text[order - 1]  # of place 0 the final separator: the text as a ring
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        start_of_run = np.zeros(n, dtype=bool)
        start_of_run[0] = True
        start_of_run[1:] = text[:-1] == 0  # no walk passes a separator
        sampled = (order % SAMPLE == 0) | start_of_run[order]
        self.sampled, self.samples = Bits(sampled), order[sampled]
        self.levels, self.zeros = [], []
        row = last.astype(np.int64)
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bit = (row >> shift) & 1 == 1
            self.levels.append((shift, Bits(bit)))
            self.zeros.append(int(n - bit.sum()))
            row = np.concatenate([row[~bit], row[bit]])
        # where each symbol's run begins below the last level
        self.leaf = self._down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for (shift, bits), zeros in zip(self.levels, self.zeros, strict=True):
            ones = bits.rank(i)
            i = np.where((symbol >> shift) & 1 == 1, zeros + ones, i - ones)
        return i

    def _step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.starts[symbol] + self._down(symbol, i) - self.leaf[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each row of ``patterns`` (padded at the left)."""
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n, dtype=np.int64)
        width = patterns.shape[1]
        for back in range(1, width + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, width - back]
            low[live], high[live] = self._step(symbol, low[live]), self._step(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, place: np.ndarray) -> np.ndarray:
        """The text position of each place in the suffix order."""
        place, out = place.copy(), np.empty(len(place), dtype=np.int64)
        todo, steps = np.arange(len(place)), 0
        while len(todo):
            at = place[todo]
            done = self.sampled.get(at) == 1
            out[todo[done]] = self.samples[self.sampled.rank(at[done])] + steps
            todo, at = todo[~done], at[~done]
            symbol, i = np.zeros(len(at), dtype=np.int64), at
            for (_, bits), zeros in zip(self.levels, self.zeros, strict=True):
                bit, ones = bits.get(i), bits.rank(i)
                symbol = symbol * 2 + bit
                i = np.where(bit == 1, zeros + ones, i - ones)
            place[todo] = self.starts[symbol] + i - self.leaf[symbol]
            steps += 1
        return out
