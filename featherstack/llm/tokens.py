"""Words of whole texts as 64-bit hashes, many texts at a time in numpy.

Texts are laid end to end in slices of about SLICE bytes; one running sum of
``table[byte] * BASE ** place`` gives every word's hash as a difference of two
of its values, so no word is ever a Python object.  A longer text is cut at
white space into several slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

from .common import mix64

SLICE = 1 << 20
END = np.uint64(0x6A09E667F3BCC909)  # the token that ends a text
BLANK = 32
#: ASCII white space is a blank, A-Z are lower-cased, other bytes are kept.
SPACED = bytes(BLANK if b in b"\t\n\x0b\x0c\r " else b + 32 if 65 <= b < 91 else b for b in range(256))
_TABLE = np.random.default_rng(13).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[BLANK] = 0
_BASE = 0xD1342543DE82EF95  # 5 modulo 8, so its powers differ for 2**62 places


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return tuple(out)


@dataclass
class Slice:
    """Tokens of some texts; ``doc`` is the place of each token's text."""
    hashes: np.ndarray
    doc: np.ndarray


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes, bool]]]:
    """(text, bytes, whether it ends) in groups of about SLICE bytes."""
    held, size = [], 0
    for i, text in enumerate(texts):
        begin = 0
        while True:
            end = len(text)
            if end - begin > SLICE:
                end = begin + SLICE
                cut = max(text.rfind(bytes([w]), begin + 1, end) for w in (9, 10, 11, 12, 13, 32))
                if cut < 0:  # one word longer than a slice
                    cuts = [c for w in (9, 10, 11, 12, 13, 32) if (c := text.find(bytes([w]), end)) >= 0]
                    cut = min(cuts, default=len(text))
                end = cut
            held.append((i, text[begin:end], end == len(text)))
            size += end - begin
            if size >= SLICE:
                yield held
                held, size = [], 0
            begin = end
            if begin >= len(text):
                break
    if held:
        yield held


def _words(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each word begins, its hash) of bytes in which blanks part words."""
    edge = np.flatnonzero(np.diff(np.concatenate([[True], joined == BLANK, [True]]).astype(np.int8)))  # a word's begin, its end, ...
    begin, end = edge[0::2], edge[1::2]
    power, inverse = _powers(1 << max(20, int(max(len(joined) - 1, 1)).bit_length()))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[joined] * power[:len(joined)], dtype=np.uint64)])
    return begin, mix64((running[end] - running[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def slices(texts: list[bytes], table: bytes = SPACED, ends: bool = True) -> Iterator[Slice]:
    """The tokens of all texts: words, parted by what ``table`` makes a blank, and (with ``ends``) END after each text.

    ASCII white space must be blank.
    """
    for group in _pieces(texts):
        joined = np.frombuffer(b" ".join(p[1] for p in group).translate(table), np.uint8)
        begin, hashes = _words(joined)
        piece = np.searchsorted(np.cumsum([len(p[1]) + 1 for p in group]), begin, side="right")
        if ends:  # after the last word of each piece that ends its text
            last = np.flatnonzero([p[2] for p in group])
            at = np.searchsorted(piece, last, side="right")
            hashes, piece = np.insert(hashes, at, END), np.insert(piece, at, last)
        yield Slice(hashes, np.array([p[0] for p in group], np.int64)[piece])


def text_hashes(texts: list[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(the word hashes of all texts, the number of words of each)."""
    parts = list(slices(texts, table, ends=False))
    hashes = np.concatenate([p.hashes for p in parts]) if parts else np.zeros(0, np.uint64)
    docs = np.concatenate([p.doc for p in parts]) if parts else np.zeros(0, np.int64)
    return hashes, np.bincount(docs, minlength=len(texts))
