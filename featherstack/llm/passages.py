"""Substring dedup: fuzzy passages that repeat across documents, by collinear chaining.

1. Seeds: of every ``WINDOW`` consecutive ``K``-word shingles of a text the one
   of the smallest hash; of a hash that keeps recurring one in AGAIN words.  A
   seed carries a sketch of its context: two bits of each of the REACH words on
   either side.
2. The holders of a seed meet in one task, by id.  Each is compared, by sketch,
   with the NEAR holders before it and, where a seed has more, with the first
   holder of the seed and the first that agrees on each of the MASKS of the
   context, so a holder is matched with those whose context agrees, rarely hidden
   by unrelated smaller ones.  Of its candidates a holder keeps the first
   that agrees and those that agree further than the ones kept, so a passage of
   n copies gives about n - 1 matches for each seed.
3. The matches of a document and a smaller holder are chained: the best sequence
   that moves forward in both texts, each match worth K words, each step costing
   GAP for every word it moves, found with a Fenwick tree of prefix maxima.
   Chains are cut where a step leaps more than LEAP words.
4. Chains are aligned: the words between matches by edit distance, the two ends
   outward with edits, at most SHIFT words off the diagonal, until the score falls
   DROP below its best; chains whose sides share too few pairs of neighbouring words
   to become a passage are left out before; wrong words at the very ends are not part of a passage.
   Passages of ``min_words`` words and ``identity`` are kept.

A document's row tells which word spans repeat elsewhere, and which of them a
deduplication drops (those that a smaller id holds).  Words are runs of ASCII
letters, digits and non-ASCII bytes, A-Z lower-cased; positions count words.

Seeds cross one shuffle.  A task holds the rows of one seed only until it has
compared them and keeps of a longer run the rows that later ones are compared
with; chains, alignments and spans are bounded by the documents that they come
from.  Spans are merged by blocks of starts before they meet, so a passage with
a third of all documents is a few rows.

Cases: NULL, empty and short texts have no passages; documents without passages
have no row; repetition inside one document does not count; a NULL id takes no
part; rows that share an id are one document's parts and match other ids only;
empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import bucket_of, heavy_buckets
from .common import groups, map_batches, mix64, stage_table
from .components import connected_components
from .decontaminate import WORD_BYTES
from .tokens import text_hashes

K = 4  # words in a seed
WINDOW = 6  # shingles of which one is a seed
GAP = 0.1  # cost of a word that a chain's step moves, in either text
LEAP = 40  # words that a step may move
RECUR = 16  # words within which a hash recurs
AGAIN = 24  # words in which a hash that recurs is one seed
REACH = 16  # words on either side in a sketch
AGREE = 10  # words of one side that agree by sketch, of REACH
BOTH = 17  # words of both sides
CLOSE = 6  # words next to the seed that agree without a gap
FURTHER = 2  # words beyond which a candidate agrees further
NEAR = 4  # holders before a row with which it is compared
RUN_ROWS = 1 << 18  # rows that are compared at once
SEED_BYTES = 1 << 20  # text whose seeds are found at once
TABLE_BITS = 24  # slots for the pairs of neighbouring words of a slice of chains
SLICE_ROWS = 2048  # slices whose pairs are looked up at once
EXTEND = 96  # words fetched around a chain
DROP = 12  # score that an extension may lose
MISS = 2  # what a wrong word costs an extension
SHIFT = 8  # words that an extension may leave its diagonal
MIN_WORDS = 50
IDENTITY = 0.8
MERGE = 32  # starts of passages this near overlap: fewer words than a passage has


def _mask(begin: int, end: int) -> int:
    """The bits of a sketch's words: 0 to REACH - 1 leftwards from the seed, then rightwards."""
    return sum(3 << 2 * i for i in range(begin, end))


MASKS = [0, *(_mask(i, i + n) for n in (REACH, REACH // 2, REACH // 4) for i in range(0, 2 * REACH, n))]


def seeds(w: np.ndarray, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, positions, sketches, texts) of the seeds of texts whose words follow each other."""
    sizes = np.array([len(w)]) if sizes is None else sizes
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(w)) + (2 * text + 1) * REACH  # REACH words of padding on either side of a text
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w, dtype=np.uint64)])
    own = mix64(total[begin + sizes] - total[begin] + np.uint64(1))
    padded = mix64(np.repeat(own, sizes + 2 * REACH) + np.arange(len(w) + 2 * REACH * len(sizes), dtype=np.uint64))  # of each text its own
    padded[place] = w
    at = place[np.arange(len(w)) - begin[text] <= sizes[text] - K]
    score = np.full(len(padded), np.iinfo(np.uint64).max)
    score[at] = mix64(_polynomial(padded, at, K))
    low = np.lib.stride_tricks.sliding_window_view(score, WINDOW).min(axis=1) if len(at) else score
    top = low.copy()
    for i in range(1, WINDOW):
        np.maximum(top[i:], low[:-i], out=top[i:])
    at = at[score[at] == top[at]]
    order = np.lexsort((at, score[at]))
    at = at[order]
    # where a hash recurs within RECUR words, the first place and then the first in every AGAIN words from it
    first = np.ones(len(at), dtype=bool)
    first[1:] = (score[at[1:]] != score[at[:-1]]) | (np.diff(at) > RECUR)
    if not first.all():
        from_first = at[np.flatnonzero(first)[np.cumsum(first) - 1]]
        step = (at - from_first) // AGAIN
        first[1:] |= step[1:] != step[:-1]
        at = at[first]
    at = np.sort(at)
    sketch = np.zeros(len(at), np.uint64)
    for i in range(REACH):
        sketch |= padded[at - 1 - i] >> np.uint64(62) << np.uint64(2 * i) | padded[at + K + i] >> np.uint64(62) << np.uint64(2 * (REACH + i))
    first_place = begin + (2 * np.arange(len(sizes)) + 1) * REACH
    text = np.searchsorted(first_place, at, side="right") - 1
    return score[at], at - first_place[text], sketch, text


def _polynomial(w: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for i in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[at + i]
    return h


def _seed_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first, size = [], 0, 0
            for i, text in enumerate(batch.column("text")):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= SEED_BYTES or i + 1 == batch.num_rows:
                    w, sizes = text_hashes(texts, WORD_BYTES)
                    h, at, sketch, row = seeds(w, sizes)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("id").take(pa.array(row + first)),
                                                      pa.array(at.astype(np.int32)), pa.array(sketch.view(np.int64))], names=["h", "id", "pos", "sketch"])
                    texts, first, size = [], i + 1, 0
    return map_batches(docs, run, f"h long, id {dict(docs.dtypes)['id']}, pos int, sketch long")


def agreement(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words that two sketches agree on to the left and to the right, and whether that tells a shared context."""
    x = a ^ b
    same = ~(x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)
    left, right = np.bitwise_count(same & np.uint64(0xFFFFFFFF)).astype(np.int8), np.bitwise_count(same >> np.uint64(32)).astype(np.int8)
    close = np.uint64(_mask(0, CLOSE) & 0x5555555555555555)
    beside = ((same & close) == close) | ((same >> np.uint64(32) & close) == close)
    return left, right, beside | (np.maximum(left, right) >= AGREE) | (left + right >= BOTH)


def link(h: np.ndarray, ids: np.ndarray, sketch: np.ndarray, n_old: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches (row, smaller row) among rows sorted by (h, id), but none of the first
    ``n_old`` rows, and whether a later row of the same seed is to be compared with a row."""
    n = len(h)
    new = np.concatenate([[True], h[1:] != h[:-1]])
    run = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, n))
    rows = np.flatnonzero((ids[begin] != ids[begin + length - 1])[run])  # of seeds that several documents hold
    keep = np.zeros(n, dtype=bool)
    keep[begin] = True
    for d in range(1, NEAR + 1):
        keep[begin + np.maximum(length - d, 0)] = True
    found: list[tuple[np.ndarray, np.ndarray]] = []
    best = np.full((2, n), -1, np.int8)

    def offer(row: np.ndarray, ref: np.ndarray) -> None:
        at = (ids[row] != ids[ref]) & (row >= n_old)
        row, ref = row[at], ref[at]
        left, right, shared = agreement(sketch[row], sketch[ref])
        none = best[0, row] < 0
        further = (left > best[0, row] + FURTHER) & (left >= AGREE) | (right > best[1, row] + FURTHER) & (right >= AGREE)
        take = shared & (none | further)
        row, ref = row[take], ref[take]
        best[0, row], best[1, row] = np.maximum(best[0, row], left[take]), np.maximum(best[1, row], right[take])
        found.append((row, ref))
    long = rows[length[run[rows]] > NEAR + 1]
    for mask in MASKS if len(long) else ():
        key = mix64(h[long] + np.uint64(mask % 1000003)) ^ mix64(sketch[long] & np.uint64(mask))
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        keep[long[first]] = True
        offer(long, long[first[group]])
    for d in range(NEAR, 0, -1):
        row = rows[rows - d >= begin[run[rows]]]
        offer(row, row - d)
    row, ref = (np.concatenate(x) for x in zip(*found, strict=True))
    return row, ref, keep


def _match_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches (doc, ref, pos, ref_pos) among rows sorted by (h, id, pos)."""
    held: list[np.ndarray] = []
    n_old, wait, kind = 0, [], None

    def linked(n: int) -> pa.RecordBatch:
        h, ids, at, sketch = (c[:n] for c in held)
        row, ref, keep = link(h.view(np.uint64), ids, sketch.view(np.uint64), min(n_old, n))
        out = pa.RecordBatch.from_arrays([pa.array(ids[row], kind), pa.array(ids[ref], kind), pa.array(at[row]), pa.array(at[ref])],
                                         names=["doc", "ref", "pos", "ref_pos"])
        return out, keep

    def take() -> None:
        nonlocal held
        parts = [held, *wait] if held else wait
        held = [np.concatenate(c) for c in zip(*parts, strict=True)]
        wait.clear()
    for batch in batches:
        if not batch.num_rows:
            continue
        kind = batch.column("id").type
        wait.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "id", "pos", "sketch")])
        if sum(len(x[0]) for x in wait) < RUN_ROWS:
            continue
        take()
        last = int(np.searchsorted(held[0], held[0][-1]))  # where the last seed begins
        if last:
            yield linked(last)[0]
            held, n_old = [c[last:] for c in held], max(0, n_old - last)
        if len(held[0]) >= RUN_ROWS:  # one seed: compared as far as it is known
            out, keep = linked(len(held[0]))
            yield out
            held = [c[keep] for c in held]
            n_old = len(held[0])
    if wait:
        take()
    if held and len(held[0]):
        yield linked(len(held[0]))[0]


def chain(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """The collinear chains of matches (x, y), sorted by x, as indexes."""
    dx, dy = np.diff(x), np.diff(y)
    if (dx > 0).all() and (dy > 0).all() and (GAP * (dx + dy) <= K).all():
        found = [np.arange(len(x))]  # every step gains: one chain
    else:
        found = _chains(x.tolist(), y.tolist())
    out = []
    for c in found:
        leap = np.flatnonzero((np.diff(x[c]) > LEAP) | (np.diff(y[c]) > LEAP)) + 1
        out += np.split(c, leap)
    return out


def _chains(x: list[int], y: list[int]) -> list[np.ndarray]:
    n = len(x)
    rank = {v: i + 1 for i, v in enumerate(sorted(set(y)))}
    size = len(rank)
    best, holder = [float("-inf")] * (size + 1), [-1] * (size + 1)  # Fenwick tree of prefix maxima
    score, before = [0.0] * n, [-1] * n
    begin = 0
    while begin < n:
        end = begin
        while end < n and x[end] == x[begin]:  # matches at one place can't follow each other
            end += 1
        for i in range(begin, end):
            top, j, r = float("-inf"), -1, rank[y[i]] - 1
            while r > 0:
                if best[r] > top:
                    top, j = best[r], holder[r]
                r -= r & -r
            gain = top - GAP * (x[i] + y[i])
            score[i], before[i] = (K + gain, j) if gain > 0 else (K, -1)
        for i in range(begin, end):
            value, r = score[i] + GAP * (x[i] + y[i]), rank[y[i]]
            while r <= size:
                if value > best[r]:
                    best[r], holder[r] = value, i
                r += r & -r
        begin = end
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = before[i]
        if path:
            out.append(np.array(path[::-1]))
    return out


def edits(a: np.ndarray, b: np.ndarray) -> int:
    """Edit distance of two short word sequences."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    lead = n if same.all() else int(same.argmin())
    a, b = a[lead:], b[lead:]
    n = min(len(a), len(b))
    same = a[len(a) - n:][::-1] == b[len(b) - n:][::-1]
    tail = n if same.all() else int(same.argmin())
    a, b = a[:len(a) - tail].tolist(), b[:len(b) - tail].tolist()
    if len(a) < 2 or len(b) < 2:
        return max(len(a), len(b)) - (1 if len(a) + len(b) > 2 and (set(a) & set(b)) else 0)
    row = list(range(len(b) + 1))
    for i, u in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, v in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (u != v))
    return row[-1]


def _end(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """How far two sequences agree from their starts, each in its own words, and the
    errors: for each number of errors the furthest place on each diagonal, until the
    score, one a word and MISS less for a wrong one, falls DROP below its best."""
    a, b = a[:EXTEND + SHIFT].tolist(), b[:EXTEND + SHIFT].tolist()
    n, m = len(a), len(b)
    top, best, errors = 0.0, (0, 0, 0), 0
    reach = {0: 0}  # diagonal v - u: the furthest u
    while reach:
        for d, u in reach.items():
            while u < n and u + d < m and a[u] == b[u + d]:
                u += 1
            reach[d] = u
            score = u + d / 2 - (1 + MISS) * errors
            if score > top:
                top, best = score, (u, u + d, errors)
        errors += 1
        least = top - DROP + (1 + MISS) * errors
        after: dict[int, int] = {}
        for d, u in reach.items():
            for e, v in ((d, u + 1), (d - 1, u + 1), (d + 1, u)):
                if -SHIFT <= e <= SHIFT and v <= n and v + e <= m and v + e / 2 >= least and v > after.get(e, -1):
                    after[e] = v
        reach = after
    return best


def align(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[int, int, int, int, int]:
    """(start, end) in ``a``, (start, end) in ``b`` and the errors of a chain of matches."""
    errors = 0
    for i in range(len(x) - 1):
        u, v = x[i] + K, y[i] + K
        if x[i + 1] > u or y[i + 1] > v or x[i + 1] - x[i] != y[i + 1] - y[i]:
            shift = min(0, x[i + 1] - u, y[i + 1] - v)  # matches that overlap unevenly give words back
            errors += edits(a[u + shift:x[i + 1]], b[v + shift:y[i + 1]])
    left, left_ref, left_errors = _end(a[:x[0]][::-1], b[:y[0]][::-1])
    u, v = x[-1] + K, y[-1] + K
    right, right_ref, right_errors = _end(a[u:], b[v:])
    return x[0] - left, u + right, y[0] - left_ref, v + right_ref, errors + left_errors + right_errors


def find_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  identity: float = IDENTITY) -> DataFrame:
    """Aligned passages: (doc, start, end, ref, ref_start, ref_end, identity), where ``ref`` is a smaller id."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    id_type = dict(texts.dtypes)["id"]
    rows = _seed_rows(texts).repartition("h").sortWithinPartitions("h", "id", "pos")
    matches = map_batches(rows, _match_rows, f"doc {id_type}, ref {id_type}, pos int, ref_pos int")
    matches = matches.repartition("doc", "ref").sortWithinPartitions("doc", "ref", "pos", "ref_pos")
    chains = stage_table(map_batches(matches, _chain_rows, f"doc {id_type}, ref {id_type}, c int, x array<int>, y array<int>"))

    def ask(side: int, owner: str, at: str, own: list):
        return chains.select(F.col(owner).alias("id"), "doc", "ref", "c", F.lit(side).alias("side"),
                             F.greatest(F.element_at(at, 1) - EXTEND, F.lit(0)).alias("begin"), (F.element_at(at, -1) + K + EXTEND).alias("end"), *own)
    none = F.lit(None).cast("array<int>")
    asked = ask(0, "doc", "x", ["x", "y"]).unionByName(ask(1, "ref", "y", [none.alias("x"), none.alias("y")]))
    # a text meets what is asked of it in one task, or in several if a sketch tells that much is asked
    heavy = heavy_buckets(asked, ["id"]).scalar()
    parts = F.coalesce(F.element_at(heavy, bucket_of(["id"])), F.lit(1))
    asked = asked.withColumns({"part": F.pmod(F.xxhash64("doc", "ref", "c"), parts).cast("int"), "kind": F.lit(1), "text": F.lit(None).cast("binary")})
    copies = texts.withColumns({"part": F.explode(F.sequence(F.lit(0), parts - 1)), "kind": F.lit(0)})
    rows = copies.unionByName(asked, allowMissingColumns=True).repartition("id", "part").sortWithinPartitions("id", "part", "kind")
    slices = map_batches(rows, _slices, f"doc {id_type}, ref {id_type}, c int, side int, begin int, x array<int>, y array<int>, words binary")
    slices = slices.repartition("doc", "ref", "c").sortWithinPartitions("doc", "ref", "c", "side")

    least = shared_pairs(min_words, identity)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "start", "end", "ref", "ref_start", "ref_end", "identity"]
        types = [None, pa.int32(), pa.int32(), None, pa.int32(), pa.int32(), pa.float64()]
        got: list[tuple] = []

        def flush(column_type: pa.DataType) -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(v, t or column_type) for v, t in zip(zip(*got, strict=True), types, strict=True)], names=names)
            got.clear()
            return out
        kind = None
        for group in groups(_hopeful(batches, least), ["doc", "ref", "c"]):
            kind = group.column("doc").type
            side, begin, data = (group.column(c).to_pylist() for c in ("side", "begin", "words"))
            sides = [[(b, np.frombuffer(d, "<u4")) for s, b, d in zip(side, begin, data, strict=True) if s == k] for k in (0, 1)]
            # one slice on each side, unless rows share an id: then any that holds the matches
            doc, ref = group.column("doc")[0].as_py(), group.column("ref")[0].as_py()
            x, y = (np.array(group.column(c)[0].as_py()) for c in ("x", "y"))
            for b0, a in sides[0]:
                for b1, b in sides[1]:
                    if not _holds(a, x - b0, b, y - b1):
                        continue
                    s, e, rs, re, errors = align(a, b, (x - b0).tolist(), (y - b1).tolist())
                    length = max(e - s, re - rs)
                    if e - s >= min_words and re - rs >= min_words and 1 - errors / length >= identity:
                        got.append((doc, s + b0, e + b0, ref, rs + b1, re + b1, 1 - errors / length))
            if len(got) >= 10_000:
                yield flush(kind)
        if got:
            yield flush(kind)
    return map_batches(slices, aligned, f"doc {id_type}, start int, end int, ref {id_type}, ref_start int, ref_end int, identity double")


def shared_pairs(min_words: int, identity: float) -> int:
    """How many of its pairs of neighbouring words a passage finds again on the other side, at least: a
    wrong word spoils two, and at most ``1 - identity`` of the longer side's words are wrong."""
    return math.ceil(min_words * (2 * identity - 1) - 1 - 1e-9)


def _hopeful(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The slices without chains that can't become passages, as their two sides share too few pairs of
    neighbouring words.  Pairs are looked up in a bit table for many chains at once; a false hit only
    keeps a chain.  Chains at the ends of a batch, or with several slices on a side, are all kept."""
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(at, SLICE_ROWS)
            doc, ref, c, side = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("doc", "ref", "c", "side"))
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (ref[1:] != ref[:-1]) | (c[1:] != c[:-1])])
            group = np.cumsum(new) - 1
            data = batch.column("words").to_pylist()
            size = np.array([len(w) // 4 for w in data], np.int64)
            words = np.frombuffer(b"".join(data), "<u4").astype(np.uint64)
            row = np.repeat(np.arange(len(size)), size)
            inside = np.flatnonzero(row[1:] == row[:-1])
            own = group[row[inside]]
            slot = mix64((words[inside] << np.uint64(32) | words[inside + 1]) ^ mix64(own.astype(np.uint64) + np.uint64(1))) >> np.uint64(64 - TABLE_BITS)
            right = side[row[inside]] == 1
            table[slot[right]] = True
            found = np.bincount(own[~right][table[slot[~right]]], minlength=group[-1] + 1)
            table[slot[right]] = False
            keep = (found >= least) | (np.bincount(group) != 2)
            keep[[0, -1]] = True
            yield batch.filter(pa.array(keep[group]))


def _holds(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> bool:
    return x[-1] + K <= len(a) and y[-1] + K <= len(b) and bool((a[x[0]:x[0] + K] == b[y[0]:y[0] + K]).all())


def _chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of each (doc, ref) in sorted rows."""
    names = ["doc", "ref", "pos", "ref_pos"]
    held = None
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        kind = batch.column("doc").type
        if held is not None:
            columns = [np.concatenate([a, b]) for a, b in zip(held, columns, strict=True)]
        new = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)) + 1
        last = int(new[-1]) if len(new) else 0
        held = [c[last:] for c in columns]
        if last:
            yield _chained([c[:last] for c in columns], kind)
    if held is not None and len(held[0]):
        yield _chained(held, kind)


def _chained(columns: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    doc, ref, x, y = columns
    cuts = np.concatenate([[0], np.flatnonzero((np.diff(doc) != 0) | (np.diff(ref) != 0)) + 1, [len(doc)]])
    out: list[tuple] = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        for c, at in enumerate(chain(x[a:b], y[a:b])):
            out.append((doc[a], ref[a], c, x[a:b][at], y[a:b][at]))
    d, r, c, xs, ys = zip(*out, strict=True) if out else ((),) * 5
    return pa.RecordBatch.from_arrays([pa.array(d, kind), pa.array(r, kind), pa.array(c, pa.int32()), pa.array(xs, pa.list_(pa.int32())),
                                       pa.array(ys, pa.list_(pa.int32()))], names=["doc", "ref", "c", "x", "y"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked words of each text as 32-bit hashes; rows come by (id, part), a text before what is asked of it."""
    names, held, last = ["doc", "ref", "c", "side", "begin", "x", "y"], [], None
    for batch in batches:
        kind, key = batch.column("kind").to_pylist(), list(zip(batch.column("id").to_pylist(), batch.column("part").to_pylist(), strict=True))
        begin, end = batch.column("begin").to_pylist(), batch.column("end").to_pylist()
        rows, out = [], []
        for i, k in enumerate(kind):
            if key[i] != last:
                last, held = key[i], []
            if k == 0:  # hashed when something is asked
                held.append(batch.column("text")[i].as_py())
                continue
            for j, text in enumerate(held):  # one, unless rows share an id
                if isinstance(text, bytes):
                    text = held[j] = text_hashes([text], WORD_BYTES)[0].astype("<u4")
                rows.append(i)
                out.append(text[begin[i]:end[i]].tobytes())
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in names), pa.array(out, pa.binary())], names=[*names, "words"])


def _merged(rows: DataFrame, name: str) -> DataFrame:
    """(doc, name): the merged spans of rows (doc, start, end) that are MERGE words long at least."""
    near = rows.groupBy("doc", F.expr(f"start div {MERGE}").alias("block")).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = near.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))  # bounded by the text
    return spans.selectExpr("doc", f"""aggregate(s, cast(array() AS array<struct<start:int,end:int>>), (a, x) ->
        if(size(a) > 0 AND element_at(a, -1).end >= x.start,
           concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end)))),
           concat(a, array(x)))) AS {name}""")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      identity: float = IDENTITY) -> DataFrame:
    """One row per document with a passage that another document holds too:
    ``id``, ``component_id`` (smallest id reachable through shared passages), ``n_repeated``
    words in ``spans``, and ``n_dropped`` words in ``dropped``, the spans that a smaller id holds."""
    if min_words < MERGE:
        raise ValueError(f"min_words must be at least {MERGE}")
    found = stage_table(find_passages(docs, id_col, text_col, min_words, identity))
    own = found.select("doc", "start", "end")
    held = found.select(F.col("ref").alias("doc"), F.col("ref_start").alias("start"), F.col("ref_end").alias("end"))
    parts = connected_components(found.select(F.col("doc").alias("u"), F.col("ref").alias("v")))
    out = _merged(own.unionByName(held), "spans").join(_merged(own, "dropped"), "doc", "left").join(parts.withColumnRenamed("id", "doc"), "doc")
    total = "aggregate({0}, 0L, (n, s) -> n + s.end - s.start)"
    empty = "coalesce(dropped, cast(array() AS array<struct<start:int,end:int>>))"
    return out.selectExpr("doc AS id", "component AS component_id", total.format("spans") + " AS n_repeated", "spans",
                          total.format(empty) + " AS n_dropped", empty + " AS dropped")
