"""Byte-level BPE encoding and decoding with padded numpy matrices.

A text is cut by the tokenizer's pattern; each piece is a token of the
vocabulary or is merged from its bytes.  Pieces that a worker has not met yet
are merged together: rows of a matrix for each length bucket, where every
round merges each row's leftmost pair of the lowest rank, looked up in an
open-addressing hash table of pairs, and rows without pairs leave the matrix.
A piece longer than the widest bucket is merged by a heap in the same order.

The vocabulary is a file read by the driver and broadcast (tens of thousands
of entries whatever the corpus).

Cases: NULL is the empty text, with no tokens; bytes that are not UTF-8 become
U+FFFD before encoding; very long texts and pieces are encoded whole; an empty
table gives an empty result; input columns with an output's name are replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extend, map_batches, mix64, unused, without

WIDTHS = (2, 4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 128, 256)
NONE = np.int32(2**31 - 1)
CACHE = 250_000  # pieces that a worker remembers
SLICE_BYTES = 1 << 20  # text handled at once


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]


class Pairs:
    """Hash table from a pair of token ids to the id of their concatenation."""

    def __init__(self, ranks: dict[bytes, int]):
        base = max(ranks.values()) + 1
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * base + right)
                    values.append(rank)
        self.base = base
        bits = max(4, int(len(keys) * 2).bit_length())
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, NONE, dtype=np.int32)
        key, value = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[free]  # of several keys for a slot the last one stays
            won = self.keys[slot] == key
            self.values[slot[won]] = value[won]
            key, value, slot = key[~won], value[~won], (slot[~won] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return mix64(key.view(np.uint64)).view(np.int64) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, NONE if there is none or a side is negative."""
        key = left.astype(np.int64) * self.base + right
        slot = self._slot(key)
        at = self.keys[slot]
        out = np.where(at == key, self.values[slot], NONE)
        todo = np.flatnonzero((at != key) & (at >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            at = self.keys[slot[todo]]
            same = at == key[todo]
            out[todo[same]] = self.values[slot[todo[same]]]
            todo = todo[~same & (at >= 0)]
        out[(left < 0) | (right < 0)] = NONE
        return out


class Tokenizer:
    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str):
        self.ranks = dict(ranks)
        self.pieces = regex.compile(pattern)
        self.pairs = Pairs(self.ranks)
        self.tokens = {rank: token for token, rank in ranks}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.cache: dict[str, bytes] = {}
        self.by_pair: dict[int, int] | None = None

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.pieces.findall(t) for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = list(set().union(*cut).difference(self.cache))
        if new:
            self._learn(new)
        return [b"".join(map(self.cache.__getitem__, c)) for c in cut]

    def _learn(self, pieces: list[str]) -> None:
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.cache[piece] = rank.to_bytes(4, "little")
            elif len(raw) > WIDTHS[-1]:
                self.cache[piece] = self._merge_long(raw)
            else:
                width = next(w for w in WIDTHS if len(raw) <= w)
                buckets.setdefault(width, []).append((piece, raw))
        for width, rows in buckets.items():
            for (piece, _), ids in zip(rows, self._merge([raw for _, raw in rows], width), strict=True):
                self.cache[piece] = ids

    def _merge(self, rows: list[bytes], width: int) -> list[bytes]:
        """All rows of a bucket at once, one merge in each row every round."""
        n = len(rows)
        lengths = np.fromiter(map(len, rows), np.int64, n)
        ids = np.full((n, width), -1, dtype=np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        ranks = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        done: list[bytes] = [b""] * n
        row = np.arange(n)
        column = np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(row)), at]
            over = best == NONE
            if over.any():
                for r, x in zip(row[over].tolist(), ids[over], strict=True):
                    done[r] = x[x >= 0].astype("<u4").tobytes()
                keep = ~over
                ids, ranks, row, at, best = ids[keep], ranks[keep], row[keep], at[keep], best[keep]
            if not len(row):
                return done
            k = np.arange(len(row))
            # close the gap behind the merged pair, then look up the two pairs beside it
            take = column + (column > at[:, None])
            take[:, -1] = width - 1
            ids = np.take_along_axis(ids, take, axis=1)
            ids[:, -1] = -1
            ids[k, at] = best
            ranks = np.take_along_axis(ranks, np.minimum(take[:, :-1], width - 2), axis=1)
            ranks[:, -1] = NONE
            after = np.minimum(at + 1, width - 1)
            ranks[k, np.minimum(at, width - 2)] = np.where(at + 1 < width, self.pairs.find(ids[k, at], ids[k, after]), NONE)
            left = at > 0
            ranks[k[left], at[left] - 1] = self.pairs.find(ids[k[left], at[left] - 1], ids[k[left], at[left]])

    def _merge_long(self, raw: bytes) -> bytes:
        """A linked list and a heap of (rank, place): the same order of merges in n log n."""
        if self.by_pair is None:
            used = self.pairs.keys >= 0
            self.by_pair = dict(zip(self.pairs.keys[used].tolist(), self.pairs.values[used].tolist(), strict=True))
        find, base = self.by_pair.get, self.pairs.base
        ids = self.byte_ids[np.frombuffer(raw, np.uint8)].tolist()
        n = len(ids)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := find(ids[i] * base + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i]
            if ids[i] < 0 or j >= n or find(ids[i] * base + ids[j]) != rank:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
                if (r := find(rank * base + ids[right[j]])) is not None:
                    heapq.heappush(heap, (r, i))
            if left[i] >= 0 and (r := find(ids[left[i]] * base + rank)) is not None:
                heapq.heappush(heap, (r, left[i]))
        return np.array([x for x in ids if x >= 0], dtype="<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_ids`` (binary: little-endian unsigned 32-bit integers).

    With ``decoded`` also the bytes that these ids stand for, as :func:`decode`
    gives them, in the same pass (one Python worker a task instead of two).
    """
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())]
    added += [T.StructField("decoded", T.BinaryType())] * decoded
    docs = without(docs, *(f.name for f in added))
    helper = unused(docs, "__text")
    sent = docs.sparkSession.sparkContext.broadcast((read_ranks(path), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(*sent.value)
        for part in (p for b in batches for p in _slices(b)):
            texts = [(t.as_py() or b"").decode("utf-8", "replace") for t in part.column(helper)]
            ids = tokenizer.encode(texts)
            new = {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "token_ids": pa.array(ids, pa.binary())}
            if decoded:
                new["decoded"] = pa.array(map(tokenizer.decode, ids), pa.binary())
            yield extend(part, new, drop=[helper])
    return map_batches(docs.withColumn(helper, F.col(text_col).cast("binary")), run, T.StructType([*docs.schema, *added]))


def decode(docs: DataFrame, path: str, ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``, the bytes that the ids stand for (NULL ids: NULL)."""
    docs = without(docs, "decoded")
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = {rank: token for token, rank in sent.value}.__getitem__
        for part in (p for b in batches for p in _slices(b)):
            out = [b"".join(map(find, np.frombuffer(x.as_py(), "<u4").tolist())) if x.is_valid else None for x in part.column(ids_col)]
            yield extend(part, {"decoded": pa.array(out, pa.binary())})
    return map_batches(docs, run, T.StructType([*docs.schema, T.StructField("decoded", T.BinaryType())]))
