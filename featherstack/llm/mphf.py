"""Minimal perfect hash over 128-bit keys, in numpy.

Levels of bit arrays: a key owns its bit at the first level where no other
remaining key falls on the same position; its index is the rank of that bit
over all levels.  About 3 bits a key at ``GAMMA`` = 2.  A key that is not in
the set gets an arbitrary index or -1, so callers keep a fingerprint per index.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import mix64

GAMMA = 2.0  # positions per remaining key at each level
MAX_LEVELS = 48  # keys left after these are kept in a sorted list


def _position(lo: np.ndarray, hi: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    return (mix64(lo ^ mix64(hi + salt)) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    bits: list[np.ndarray]  # a bit array for each level, packed in 64-bit words
    ranks: list[np.ndarray]  # set bits before each word, over all levels
    rest: np.ndarray  # (n, 2) keys that no level separated, sorted
    size: int

    @classmethod
    def build(cls, lo: np.ndarray, hi: np.ndarray) -> PerfectHash:
        """Over distinct keys ``(lo, hi)``, two unsigned 64-bit halves."""
        bits, ranks, placed, n = [], [], 0, len(lo)
        for level in range(MAX_LEVELS):
            if not len(lo):
                break
            words = max(1, int(np.ceil(GAMMA * len(lo) / 64)))
            pos = _position(lo, hi, level, words * 64)
            alone = np.bincount(pos, minlength=words * 64) == 1
            packed = np.packbits(alone, bitorder="little").view(np.uint64)
            counts = np.bitwise_count(packed).astype(np.int64)
            ranks.append(placed + np.cumsum(counts) - counts)
            bits.append(packed)
            placed += int(counts.sum())
            left = ~alone[pos]
            lo, hi = lo[left], hi[left]
        order = np.lexsort((hi, lo))
        return cls(bits, ranks, np.stack([lo[order], hi[order]], axis=1), n)

    def arrays(self) -> dict[str, np.ndarray]:
        """The table as plain arrays, for :meth:`of`."""
        whole = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((self.bits, np.uint64), (self.ranks, np.int64))]
        return {"bits": whole[0], "ranks": whole[1], "words": np.array([len(b) for b in self.bits], np.int64), "rest": self.rest.ravel()}

    @classmethod
    def of(cls, bits: np.ndarray, ranks: np.ndarray, words: np.ndarray, rest: np.ndarray, size: int) -> PerfectHash:
        """The table of :meth:`arrays`, which may be memory-mapped and are not copied."""
        cuts = np.cumsum(words)[:-1]
        return cls(np.split(bits, cuts) if len(words) else [], np.split(ranks, cuts) if len(words) else [], np.asarray(rest).reshape(-1, 2), size)

    def index(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The index of each key, below ``size``; -1 where a key can't be in the set."""
        out = np.full(len(lo), -1, dtype=np.int64)
        todo = np.arange(len(lo))
        for level, (packed, ranks) in enumerate(zip(self.bits, self.ranks, strict=True)):
            if not len(todo):
                return out
            pos = _position(lo[todo], hi[todo], level, len(packed) * 64)
            word, bit = pos >> 6, (pos & 63).astype(np.uint64)
            found = (packed[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(packed[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[found]] = (ranks[word] + below)[found]
            todo = todo[~found]
        if len(self.rest) and len(todo):
            known = {(int(a), int(b)): i for i, (a, b) in enumerate(self.rest)}
            first = self.size - len(self.rest)
            for i in todo:
                j = known.get((int(lo[i]), int(hi[i])))
                if j is not None:
                    out[i] = first + j
        return out
