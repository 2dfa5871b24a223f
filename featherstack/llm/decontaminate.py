"""Benchmark decontamination with an FM-index for each shard of documents.

Test phrases are windows of ``window`` consecutive words of a benchmark item
(all of a shorter item).  Each task cuts its documents into shards of about
``SHARD_WORDS`` words, builds an FM-index over the shard's word symbols,
searches all phrases backwards through the wavelet matrix, locates their
occurrences by sampled suffix positions and merges them into removal spans.

A word that no phrase uses is a separator in the index; separators in a row
are one, and runs shorter than the shortest phrase can hold no occurrence and
are left out, so the index holds exactly the text that could match.

The phrases reach the tasks as a broadcast of about ``block_bytes`` of
benchmark text; a larger benchmark is taken in several blocks, each a pass
over the documents, with the spans so far written to the shared folder.

Cases: NULL or wordless texts have no words and no hits; an item without
words is no phrase; items that share a window all count; repeated rows are
judged each for itself; empty tables give no rows or no hits; input columns
with an output's name are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extend, map_arrow, map_batches, stage_table, without
from .fmindex import FMIndex

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 << 20
#: A-Z lower-cased, ASCII that is no letter or digit blank, other bytes kept.
WORD_BYTES = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


class Phrases:
    """The distinct test phrases of a block of items, as symbols."""

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        found: dict[tuple[bytes, ...], set] = {}
        for item, text in items:
            w = words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[i:i + window]), set()).add(item)
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for p in found for w in p}), 1)}
        self.items = [sorted(str(x) for x in s if x is not None) for s in found.values()]
        self.lengths = np.array([len(p) for p in found], dtype=np.int64)
        self.patterns = np.zeros((len(found), window), dtype=np.int64)
        for i, p in enumerate(found):
            self.patterns[i, window - len(p):] = [self.vocabulary[w] for w in p]
        self.shortest = int(self.lengths.min()) if found else 0


def find_spans(texts: list[list[bytes]], phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[list[str]]]:
    """Merged word spans [start, end) of each text that any phrase covers, and the items found."""
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    get = phrases.vocabulary.get
    sizes = np.array([len(w) + 1 for w in texts], dtype=np.int64)  # a separator ends each text
    if not len(phrases.lengths) or sizes.sum() == len(texts):
        return spans, [[] for _ in texts]
    symbols = np.zeros(int(sizes.sum()), dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    for begin, w in zip(begins, texts, strict=True):
        symbols[begin:begin + len(w)] = np.fromiter(map(get, w, repeat(0)), np.int64, len(w))
    # what could match: runs of known words of the shortest phrase's length or more, and one separator after each
    known = np.concatenate([[False], symbols > 0])
    edges = np.flatnonzero(known[1:] != known[:-1])
    runs = edges.reshape(-1, 2)  # the last symbol is a separator, so edges come in pairs
    runs = runs[runs[:, 1] - runs[:, 0] >= phrases.shortest]
    if not len(runs):
        return spans, [[] for _ in texts]
    size = runs[:, 1] - runs[:, 0] + 1
    offset = np.cumsum(size) - size
    where = np.arange(int(size.sum())) + np.repeat(runs[:, 0] - offset, size)
    index = FMIndex(symbols[where], len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.patterns, phrases.lengths)
    hit = np.flatnonzero(high > low)
    count = (high - low)[hit]
    phrase = np.repeat(hit, count)
    place = np.arange(int(count.sum())) + np.repeat(low[hit] - (np.cumsum(count) - count), count)
    at = where[index.locate(place)]
    text = np.searchsorted(begins, at, side="right") - 1
    order = np.lexsort((at, text))
    for t, p, i in zip(text[order].tolist(), phrase[order].tolist(), at[order].tolist(), strict=True):
        start = i - int(begins[t])
        _append(spans[t], (start, start + int(phrases.lengths[p])))
        items[t].update(phrases.items[p])
    return spans, [sorted(s) for s in items]


def _append(spans: list[tuple[int, int]], new: tuple[int, int]) -> None:
    """Adds a span that begins no earlier than the last one."""
    if spans and new[0] <= spans[-1][1]:
        spans[-1] = (spans[-1][0], max(spans[-1][1], new[1]))
    else:
        spans.append(new)


def merge(*parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for span in sorted(s for part in parts for s in part):
        _append(out, span)
    return out


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` (word positions, merged) and ``items`` (found item ids as sorted text)."""
    docs = without(docs, "n_words", "n_hit", "spans", "items")
    order = docs.columns
    phrases = items.select(F.col(item_id).alias("id"), F.col(item_text).cast("binary").alias("text")).where("text IS NOT NULL")
    total = phrases.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    at = docs.withColumn(text_col, F.col(text_col).cast("binary")).withColumns({
        "n_words": F.lit(0).cast("long"), "spans": F.array().cast(SPANS), "items": F.array().cast("array<string>")})
    for b in range(blocks):
        if b:
            at = stage_table(at)
        block = phrases.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)  # about block_bytes
        at = _pass(at, [(r["id"], bytes(r["text"])) for r in block.collect()], text_col, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return at.select(*[F.col(c).cast("string").alias(c) if c == text_col else c for c in order],
                     "n_words", hit.alias("n_hit"), "spans", "items")


def _pass(docs: DataFrame, items: list[tuple[object, bytes]], text_col: str, window: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((items, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(*sent.value)
        for batch in batches:
            first, waiting, size = 0, [], 0
            for i, text in enumerate(batch.column(text_col)):
                w = words(text.as_py())
                waiting.append(w)
                size += len(w)
                if size >= SHARD_WORDS or i + 1 == batch.num_rows:
                    yield done(batch.slice(first, len(waiting)), waiting, phrases)
                    first, waiting, size = i + 1, [], 0

    def done(batch: pa.RecordBatch, texts: list[list[bytes]], phrases: Phrases) -> pa.RecordBatch:
        spans, items = find_spans(texts, phrases)
        before = [[(s["start"], s["end"]) for s in x] for x in batch.column("spans").to_pylist()]
        spans = [[{"start": a, "end": b} for a, b in merge(x, y)] for x, y in zip(spans, before, strict=True)]
        items = [sorted({*x, *y}) for x, y in zip(items, batch.column("items").to_pylist(), strict=True)]
        return extend(batch, {
            "n_words": pa.array([len(w) for w in texts], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            "items": pa.array(items, pa.list_(pa.string()))}, drop=["n_words", "spans", "items"])
    return map_batches(docs, run, docs.schema)


def cut_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The output of :func:`find_contamination` with the spans' words, and what stands between them, cut from the text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text, spans in zip(batch.column(text_col), batch.column("spans"), strict=True):
            text = text.as_py()
            if text is not None and len(spans):
                at = [m.span() for m in _WORD.finditer(text)]
                for s in reversed(spans.as_py()):
                    text = text[:at[s["start"]][0]] + text[at[s["end"] - 1][1]:]
            texts.append(text)
        i = batch.schema.get_field_index(text_col)
        return batch.set_column(i, text_col, pa.array(texts, pa.binary()))
    raw = docs.withColumn(text_col, F.col(text_col).cast("binary"))
    return map_arrow(raw, run, raw.schema).withColumn(text_col, F.col(text_col).cast("string"))
