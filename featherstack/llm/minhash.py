"""MinHash near-dedup with tensored banding, verified on full shingle sets.

A document's set holds its distinct word shingles.  Instead of a fresh band of
minhashes for each of ``side * side`` tables, two collections of ``side`` short
hashes (``BAND`` minhashes each) are computed, and table (i, j) is keyed by the
i-th hash of the first collection with the j-th of the second: 2 * side short
hashes give side * side tables, so minhash work grows with the root of the
tables.  Two sets of similarity s meet in some table with probability
``(1 - (1 - s**BAND)**side)**2``, above 0.9999 at 0.85.

1. Equal sets are one representative, the smallest id; only those go on.
2. A short hash that no other representative has can't give a shared table,
   so tables are formed from shared short hashes only.
3. Every bucket offers its smallest id as a centre; a representative is
   compared with the smallest centre that it is offered.
4. Representatives are put in families, by the smallest centre within two
   steps.  Families with several components are cut into blocks, and each pair
   of blocks is one group of bounded size, in which every pair that shares a
   table, is not yet connected and has lengths that can reach the threshold is
   compared; only links come out.  Such pairs across families are listed, each
   where it meets first.  So each pair that shares a table is either compared
   or connected already.

Candidates are confirmed on the full sets, rebuilt from the texts of the
documents that share a bucket: a centre's text is sent to its members in
groups of at most about CHUNK.  Components are found by distributed stars.

Cases: NULL or wordless texts have an empty set, size 0, and are linked with
nothing; fewer words than a shingle make one shingle; a NULL id is linked with
nothing; rows that share an id share a result; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, map_batches, mix64, stage_table
from .components import connected_components

SIDE = 8  # short hashes in each collection; SIDE * SIDE tables
BAND = 2  # minhashes in a short hash
SEED = 7
CHUNK = 256  # texts that meet one copy of their centre
BLOCK = 1024  # members of a bucket in a block
FAMILY_BLOCK = 512  # members of a family in a block
COLUMNS = 4096  # shingles of a block counted at once
PAIRS = 100_000  # pairs of a group whose hashes are compared at once
WORDS_KEPT = 500_000  # word hashes that a worker remembers

_rng = np.random.default_rng(SEED)
_XOR = _rng.integers(0, 2**63, 2 * SIDE * BAND, dtype=np.uint64)[:, None]
_MUL = _rng.integers(0, 2**63, 2 * SIDE * BAND, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes | None, k: int, hashes: WordHashes) -> np.ndarray:
    """The distinct 64-bit hashes of ``k``-word shingles of the text (A-Z lower-cased,
    words cut at ASCII white space), sorted."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(k, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) ^ w[i:i + len(h)])
    return np.unique(h)


def short_hashes(grams: np.ndarray) -> np.ndarray:
    """2 * SIDE short hashes, each of BAND minhashes of the set."""
    low = np.empty(2 * SIDE * BAND, np.uint64)
    for i in range(0, len(low), SIDE):  # a slice of functions at once keeps long texts in cache
        x = (grams ^ _XOR[i:i + SIDE]) * _MUL[i:i + SIDE]
        x ^= x >> np.uint64(32)
        low[i:i + SIDE] = (x * _MUL[i:i + SIDE]).min(axis=1)
    out = np.zeros(2 * SIDE, np.uint64)
    for b in range(BAND):
        out = mix64(out * np.uint64(31) + low[b::BAND])
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, n, d0, d1, keys): set size, 128-bit digest of the set and the short hashes (none for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            n, digest, keys = [], [], []
            for text in batch.column("text"):
                grams = shingles(text.as_py(), k, hashes)
                n.append(len(grams))
                digest.append(xxhash.xxh3_128_digest(grams.tobytes()))
                keys.append(short_hashes(grams).view(np.int64) if len(grams) else None)
            both = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]),
                                              pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "d0", "d1", "keys"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(rows, run, f"id {dict(rows.dtypes)['id']}, n long, d0 long, d1 long, keys array<long>")


def tables(reps: DataFrame) -> DataFrame:
    """(t, key, id): the table entries of representatives that may share one."""
    own = reps.select("id", F.posexplode("keys").alias("at", "hash"))
    shared = own.groupBy("at", "hash").agg(F.count("*").alias("c")).where("c > 1")
    masks = own.join(shared, ["at", "hash"]).groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask"))
    both = f"(shiftright(mask, i) & shiftright(mask, j + {SIDE}) & 1L) = 1L"
    entries = f"""inline(filter(flatten(transform(sequence(0, {SIDE - 1}), i -> transform(sequence(0, {SIDE - 1}), j ->
        if({both}, named_struct('t', i * {SIDE} + j, 'key', xxhash64(keys[i], keys[j + {SIDE}])), NULL)))), x -> x IS NOT NULL))"""
    return reps.join(masks, "id").selectExpr("id", entries)


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The (a, b) among ``pairs`` whose sets have ``100 * common >= percent * union``."""
    texts = texts.select("id", "text")
    id_type = dict(texts.dtypes)["id"]
    # a centre with many members gets one copy of its text for each CHUNK of them
    counts = pairs.groupBy("a").agg(F.count("*").alias("c")).select("a", F.ceil(F.col("c") / CHUNK).cast("int").alias("chunks"))
    members = pairs.join(counts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"), "b")
    centres = counts.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("a").alias("b"))
    rows = members.unionByName(centres).join(texts, F.col("b") == F.col("id")).select("a", "chunk", (F.col("a") != F.col("b")).alias("member"), "b", "text")
    rows = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, centres, held = WordHashes(), [], None
        for batch in batches:
            a, chunk = batch.column("a").to_pylist(), batch.column("chunk").to_pylist()
            member, b = batch.column("member").to_pylist(), batch.column("b").to_pylist()
            out = []
            for i, text in enumerate(batch.column("text")):
                grams = shingles(text.as_py(), k, hashes)
                if held != (a[i], chunk[i]):
                    centres, held = [], (a[i], chunk[i])
                if not member[i]:
                    centres.append(grams)  # one, unless rows share an id
                elif any(_similar(c, grams, percent) for c in centres):
                    out.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], batch.column("a").type) for c in (0, 1)], names=["a", "b"])
    return map_batches(rows, run, f"a {id_type}, b {id_type}")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or not len(x):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _across(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of one bucket but of different components and families, each where it meets first.

    ``entries``: (t, key, id, n, keys, component, family) of buckets with several of both.
    """
    id_type = dict(entries.dtypes)["id"]
    blocks = entries.groupBy("t", "key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = entries.join(blocks, ["t", "key"]).withColumn("own", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "n", "component", "family", "keys")
    rows = rows.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j", "own", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["t", "key", "i", "j"]):
            ids, n, part, family, own = (group.column(c).to_numpy() for c in ("id", "n", "component", "family", "own"))
            across = (part[:, None] != part[None, :]) & (family[:, None] != family[None, :])
            across &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
            if group.column("i")[0] != group.column("j")[0]:
                across &= own[:, None] != own[None, :]
            a, b = np.nonzero(np.triu(across, 1))
            if not len(a):
                continue
            keys = np.array(group.column("keys").to_pylist(), dtype=np.int64)
            t = group.column("t")[0].as_py()
            for k in range(0, len(a), PAIRS):
                x, y = a[k:k + PAIRS], b[k:k + PAIRS]
                same = keys[x] == keys[y]
                # the first table that a pair shares is of the first shared hash on either side
                first = same[:, :SIDE].argmax(axis=1) * SIDE + same[:, SIDE:].argmax(axis=1) == t
                x, y = ids[x[first]], ids[y[first]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])
    return map_batches(rows, run, f"a {id_type}, b {id_type}")


def _within(rows: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): links inside families with several components that connect components not yet connected.

    ``rows``: (id, n, keys, component, family).
    """
    id_type = dict(rows.dtypes)["id"]
    several = rows.groupBy("family").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("c")).where("x <> y")
    rows = rows.join(several.select("family", F.ceil(F.col("c") / FAMILY_BLOCK).cast("int").alias("blocks")), "family")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.join(texts, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "n", "component", "keys", "text")
    rows = rows.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "own", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for group in groups(batches, ["family", "i", "j"]):
            links = _block_links(group, hashes, k, percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in links], group.column("id").type) for c in (0, 1)], names=["a", "b"])
    return map_batches(rows, run, f"a {id_type}, b {id_type}")


def _block_links(group: pa.RecordBatch, hashes: WordHashes, k: int, percent: int) -> list[tuple]:
    ids, n, part, own = (group.column(c).to_numpy() for c in ("id", "n", "component", "own"))
    keys = np.array(group.column("keys").to_pylist(), dtype=np.int64)
    fits = np.triu(part[:, None] != part[None, :], 1) & (100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :]))
    if group.column("i")[0] != group.column("j")[0]:
        fits &= own[:, None] != own[None, :]
    for side in (keys[:, :SIDE], keys[:, SIDE:]):
        meets = np.zeros_like(fits)
        for c in side.T:
            meets |= c[:, None] == c[None, :]
        fits &= meets
    used = np.flatnonzero(fits.any(axis=0) | fits.any(axis=1))
    if not len(used):
        return []
    sets = [shingles(group.column("text")[int(i)].as_py(), k, hashes) for i in used]
    a, b = np.nonzero(fits[np.ix_(used, used)])
    common = _common(sets)[a, b]
    size = np.array([len(x) for x in sets])
    hit = 100 * common >= percent * (size[a] + size[b] - common)
    root = {c: c for c in part.tolist()}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    out = []
    for x, y in zip(used[a[hit]].tolist(), used[b[hit]].tolist(), strict=True):
        u, v = find(part[x].item()), find(part[y].item())
        if u != v:
            root[max(u, v)] = min(u, v)
            out.append((ids[x].item(), ids[y].item()))
    return out


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a block's sets, as products of slices of their incidence matrix."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, found = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = found[column] > 1  # a shingle of one set is in no intersection
    row, column = row[keep], column[keep]
    column = (np.cumsum(found > 1) - 1)[column]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [begin, begin + COLUMNS])
        x = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        x[row[lo:hi], column[lo:hi] - begin] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _families(members: DataFrame) -> DataFrame:
    """(id, family): the smallest centre within two steps of shared buckets."""
    near = members.groupBy("id").agg(F.min("low").alias("f"))
    low = members.join(near, "id").groupBy("t", "key").agg(F.min("f").alias("f"))
    return members.join(low, ["t", "key"]).groupBy("id").agg(F.min("f").alias("family"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id`` (the smallest id reachable by links), ``kept``."""
    signed = stage_table(signatures(docs, id_col, text_col, shingle))
    first = F.min(F.struct("id", "n", "keys")).alias("r")
    reps = stage_table(signed.where("n > 0 AND id IS NOT NULL").groupBy("d0", "d1").agg(first).select("d0", "d1", "r.*"))
    entries = stage_table(tables(reps))
    buckets = entries.groupBy("t", "key").agg(F.count("*").alias("c"), F.min("id").alias("low")).where("c > 1")
    members = stage_table(entries.join(buckets.drop("c"), ["t", "key"]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    texts = stage_table(texts.join(members.select("id").distinct(), "id", "left_semi"))

    offered = members.where("id <> low").groupBy(F.col("id").alias("b")).agg(F.min("low").alias("a"))
    links = stage_table(verify(offered, texts, shingle, percent))
    parts = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    placed = members.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    family = _families(members)
    placed = stage_table(placed.drop("low").join(family, "id"))
    ids = placed.select("id", "component", "family").distinct()
    inside = _within(ids.join(reps.select("id", "n", "keys"), "id"), texts, shingle, percent)
    edges = (F.min("component") < F.max("component")) & (F.min("family") < F.max("family"))
    several = placed.groupBy("t", "key").agg(edges.alias("several")).where("several").select("t", "key")
    left = placed.join(several, ["t", "key"]).join(reps.select("id", "n", "keys"), "id")
    outside = verify(stage_table(_across(left, percent)), texts, shingle, percent)
    more = stage_table(inside.unionByName(outside))
    if not more.isEmpty():
        links = links.unionByName(more)
        parts = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

    where = reps.select("d0", "d1", F.col("id").alias("rep")).join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    where = where.select("d0", "d1", F.coalesce("component", "rep").alias("component"))
    out = signed.drop("keys").join(where, ["d0", "d1"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
