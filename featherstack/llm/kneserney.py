"""N-gram language model: interpolated modified Kneser-Ney, counted in Spark,
kept as sorted hash arrays that workers memory-map.

Words are 64-bit hashes; the vocabulary is their sorted array, cut into shards
by the leading bits, and a word's id is its rank.  An n-gram is the ids of its
words, and its key a 64-bit hash of these.

1. Tasks combine word hashes (and later n-grams) in numpy and hand them on as
   packed arrays, one for each shard; a shard's task merges its arrays with one
   sort.  A word or n-gram with a third of all tokens is so one entry a task.
2. The highest order holds raw counts.  Each lower order is counted from the
   distinct n-grams above it (in how many different words' company an n-gram
   occurs), in the same merge; n-grams that begin a text keep their raw counts.
   N-grams are dealt by the hash of their context, so that a context's
   statistics are mostly of one shard; a context that may hold more than one
   PARTS-th of a shard is split further by its next word.
3. A shard's task writes its sorted keys and counts into the shared folder.
   Contexts (how many tokens, and how many n-grams with one, two or more)
   are combined by Spark and written the same way with the weight of the lower
   order.  What reaches the driver is one size a shard and four numbers an order.
4. Scoring maps these arrays, takes the tokens of about a megabyte of text at a
   time, and looks up their distinct keys in sorted order.

    p_n(w | h) = max(c(hw) - D(c(hw)), 0) / c(h.) + (D1 N1 + D2 N2 + D3 N3) / c(h.) * p_{n-1}(w | h')

with p_0 = 1 / (V + 1), one part of which is an unknown word's; an unseen
context passes p_{n-1} on.  Probabilities add up to 1.  Discounts follow from
the counts of counts; where these are too few to give 0 <= D <= count, they are
FALLBACK.

The tokens of a text are its words and one END; a text's first words have the
beginning as their context.  The size of every shard follows from the corpus.

Cases: NULL and empty texts are one END; a NULL id counts as '' in the held-out
rule of the query; repeated rows count each time and are scored each; without
training text every token has probability 1 / (0 + 1); a very long text is read
in slices; words of any length are one token; output names replace columns of
the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sharedfiles
from .common import extend, map_batches, mix64, row_slices, stage_table, unused, without
from .tokens import slices

ORDER = 2
ENTRIES = 2_000_000  # tokens whose n-grams make a shard
PARTS = 8  # a context of more than one PARTS-th of a shard's tokens is split
BYTES_A_TOKEN = 6
BATCH_BYTES = 4 << 20
FALLBACK = (0.5, 1.0, 1.5)
BLOBS = "level int, shard int, ids binary, counts binary"
MERGED = f"{BLOBS}, ctx long, total long, n1 long, n2 long, n3 long, n4 long, more long"


def gram_key(columns: list[np.ndarray], size: int) -> np.ndarray:
    h = np.zeros(size, np.uint64)
    for c in columns:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) ^ (c.astype(np.uint64) + np.uint64(1)))
    return h


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, where each first stands, the place of each key among them)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], order[new], place


@dataclass
class Model:
    """Where the arrays are and what they hold; small, and sent to every task."""
    folder: str
    order: int
    bits: int  # of the word hash that name a vocabulary shard
    offsets: np.ndarray  # the id of each vocabulary shard's first word, and the vocabulary's size
    tokens: int
    texts: int
    shards: int
    entries: int  # tokens whose n-grams make a shard
    id_type: str
    count_type: str
    discounts: dict[int, tuple[float, float, float]] | None = None
    context_shards: int = 1

    @property
    def words(self) -> int:
        return int(self.offsets[-1])

    @property
    def begin(self) -> int:
        """The id of the beginning of a text; ``words`` is that of an unknown word."""
        return self.words + 1

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of word hashes in ascending order."""
        ids, counts = np.full(len(hashes), self.words, np.int64), np.zeros(len(hashes), np.int64)
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        for s, part in _runs(shard):
            keys = _array(self.folder, f"vocab-{s}.key", "<u8")
            at, hit = _search(keys, hashes[part])
            ids[part][hit] = self.offsets[s] + at[hit]
            counts[part][hit] = _array(self.folder, f"vocab-{s}.n", "<u8")[at[hit]]
        return ids, counts

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        """The counts of words by id; the beginning's is the number of texts."""
        out = np.full(len(ids), self.texts, np.int64)
        shard = np.searchsorted(self.offsets, ids, side="right") - 1
        for s in np.unique(shard[ids < self.words]).tolist():
            at = shard == s
            out[at] = _array(self.folder, f"vocab-{s}.n", "<u8")[ids[at] - self.offsets[s]]
        return out

    def shard_of(self, columns: list[np.ndarray], size: int, last_count: np.ndarray | None = None) -> np.ndarray:
        """The shard of n-grams; ``last_count`` is the count of their last word but one."""
        word = mix64(columns[-1].astype(np.uint64))
        if len(columns) == 1:
            return (word % np.uint64(self.shards)).astype(np.int64)
        parts = np.uint64(1) + last_count.astype(np.uint64) // np.uint64(max(1, self.entries // PARTS))
        return (mix64(gram_key(columns[:-1], size) + word % parts) % np.uint64(self.shards)).astype(np.int64)

    def grams(self, columns: list[np.ndarray], last_count: np.ndarray | None) -> np.ndarray:
        """The (adjusted) counts of n-grams; 0 for those that aren't there."""
        n = len(columns)
        keys, first, place = distinct(gram_key(columns, len(columns[0])))
        shard = self.shard_of([c[first] for c in columns], len(first), None if last_count is None else last_count[first])
        order = np.argsort(shard, kind="stable")  # keys stay in order inside a shard
        found = np.zeros(len(keys), np.int64)
        for s, part in _runs(shard[order]):
            own = order[part]
            at, hit = _search(_array(self.folder, f"grams-{n}-{s}.key", "<u8"), keys[own])
            found[own[hit]] = _array(self.folder, f"grams-{n}-{s}.n", self.count_type)[at[hit]]
        return found[place]

    def contexts(self, columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, weight of the lower order) of contexts; 0 and 1 for unseen ones."""
        n = len(columns) + 1
        keys, _, place = distinct(gram_key(columns, size))
        total, back = np.zeros(len(keys)), np.ones(len(keys))
        shard = (keys % np.uint64(self.context_shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        for s, part in _runs(shard[order]):
            own = order[part]
            at, hit = _search(_array(self.folder, f"contexts-{n}-{s}.key", "<u8"), keys[own])
            total[own[hit]] = _array(self.folder, f"contexts-{n}-{s}.total", "<f8")[at[hit]]
            back[own[hit]] = _array(self.folder, f"contexts-{n}-{s}.back", "<f8")[at[hit]]
        return total[place], back[place]


@lru_cache(maxsize=4096)
def _array(folder: str, name: str, dtype: str) -> np.ndarray:
    return sharedfiles.load(folder, name, dtype)


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, slice]]:
    cuts = [0, *(np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1).tolist(), len(sorted_values)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            yield int(sorted_values[a]), slice(a, b)


def _search(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, whether found) of ascending ``wanted`` among the sorted ``keys``."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


# ---------------------------------------------------------------- counting
class Entries:
    """Counts of n-grams of one level, combined and handed on as a blob for each shard."""

    def __init__(self, level: int, dtype: str, count_type: str, most: int):
        self.level, self.dtype, self.count_type = level, dtype, count_type
        self.most = most  # entries that are held before they are handed on
        self.held: list[tuple[list[np.ndarray], np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, columns: list[np.ndarray], shard: np.ndarray, counts: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """``shard`` must follow from the n-gram."""
        if len(shard):
            self.held.append(_combine(columns, shard, counts, self.dtype))
            self.size += len(self.held[-1][1])
            if self.size >= self.most:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            columns = [np.concatenate(c) for c in zip(*(h[0] for h in self.held), strict=True)]
            columns, shard, counts = _combine(columns, np.concatenate([h[1] for h in self.held]), np.concatenate([h[2] for h in self.held]), self.dtype)
            self.held, self.size = [], 0
            order = np.argsort(shard, kind="stable")
            rows = [(s, b"".join(c[order[part]].tobytes() for c in columns), counts[order[part]].astype(self.count_type).tobytes())
                    for s, part in _runs(shard[order])]
            shards, ids, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([self.level] * len(rows), pa.int32()), pa.array(shards, pa.int32()),
                                              pa.array(ids, pa.binary()), pa.array(n, pa.binary())], names=["level", "shard", "ids", "counts"])


def _combine(columns: list[np.ndarray], shard: np.ndarray, counts: np.ndarray | None, dtype: str) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    key, first, place = distinct(gram_key(columns, len(shard)) if len(columns) > 1 else columns[0])
    n = np.bincount(place, minlength=len(key)) if counts is None else np.bincount(place, weights=counts, minlength=len(key))
    return [c[first].astype(dtype) for c in columns], shard[first].astype(np.int32), n.astype(np.int64)


def _unpack(table: pa.Table, width: int, dtype: str, count_type: str) -> tuple[list[np.ndarray], np.ndarray]:
    blobs = [np.frombuffer(x.as_buffer(), dtype).reshape(width, -1) for x in table.column("ids")]
    counts = np.concatenate([np.frombuffer(x.as_buffer(), count_type) for x in table.column("counts")])
    return list(np.concatenate(blobs, axis=1)), counts.astype(np.int64)


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some megabytes of rows at a time, as their texts are copied."""
    for batch in batches:
        yield from row_slices(batch, BATCH_BYTES)


def _texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [t.as_py() or b"" for t in batch.column(column)]


def _vocabulary(texts: DataFrame, folder: str, bits: int, entries: int) -> DataFrame:
    """(shard, words, tokens) of the vocabulary's shards, whose arrays are written."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Entries(0, "<u8", "<u8", entries // 2)
        for batch in _some(batches):
            for part in slices(_texts(batch)):
                yield from held.add([part.hashes], (part.hashes >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(part.hashes), np.int32))
        yield from held.flush()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        (hashes,), counts = _unpack(table, 1, "<u8", "<u8")
        (hashes,), _, counts = _combine([hashes], np.zeros(len(hashes), np.int32), counts, "<u8")
        shard = key[0].as_py()
        sharedfiles.save(folder, f"vocab-{shard}.key", hashes)
        sharedfiles.save(folder, f"vocab-{shard}.n", counts.astype("<u8"))
        return pa.table({"shard": pa.array([shard], pa.int32()), "words": pa.array([len(hashes)]), "tokens": pa.array([int(counts.sum())])})
    return map_batches(texts, count, BLOBS).groupBy("shard").applyInArrow(merge, "shard int, words long, tokens long")


@dataclass
class Sequence:
    """The ids of a slice of texts with the beginning put before each, or what a
    text's earlier slice ended in; ``depth`` tells how many ids go before each."""
    ids: np.ndarray
    counts: np.ndarray
    doc: np.ndarray
    depth: np.ndarray
    new: np.ndarray  # the slice's own tokens

    def grams(self, n: int, at: np.ndarray) -> list[np.ndarray]:
        return [self.ids[at - k] for k in range(n - 1, -1, -1)]


def sequences(texts: list[bytes], model: Model) -> Iterator[Sequence]:
    reach = model.order - 1
    tail, tail_doc = None, -1
    for part in slices(texts):
        if not len(part.doc):
            continue
        keys, _, place = distinct(part.hashes)
        ids, counts = model.look_up(keys)
        ids, counts = ids[place], counts[place]
        heads = np.flatnonzero(part.doc[1:] != part.doc[:-1]) + 1
        lead = tail if tail_doc == part.doc[0] else (np.array([model.begin]), np.array([model.texts]))
        where = np.concatenate([np.zeros(len(lead[0]), np.int64), heads])
        seq = np.insert(ids, where, np.concatenate([lead[0], np.full(len(heads), model.begin)]))
        cnt = np.insert(counts, where, np.concatenate([lead[1], np.full(len(heads), model.texts)]))
        doc = np.insert(part.doc, where, part.doc[where])
        new = np.insert(np.ones(len(ids), dtype=bool), where, False)
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        depth = np.minimum(np.arange(len(doc)) - np.repeat(first, np.diff([*first, len(doc)])), reach)
        keep = max(int(first[-1]), len(seq) - reach)
        tail, tail_doc = (seq[keep:], cnt[keep:]), int(doc[-1])
        yield Sequence(seq, cnt, doc, depth, new)


def _count_grams(texts: DataFrame, model: Model, n: int) -> DataFrame:
    """Blobs of the n-grams of the highest order, or of those of a lower one that begin a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Entries(n, model.id_type, model.count_type, model.entries // 2)
        for batch in _some(batches):
            for seq in sequences(_texts(batch), model):
                at = np.flatnonzero(seq.new & (seq.depth >= n - 1 if n == model.order else seq.depth == n - 1))
                columns = seq.grams(n, at)
                yield from held.add(columns, model.shard_of(columns, len(at), seq.counts[at - 1] if n > 1 else None))
        yield from held.flush()
    return map_batches(texts, run, BLOBS)


def _merge(blobs: DataFrame, level: int, model: Model) -> DataFrame:
    """Writes the arrays of a level; returns its contexts and the blobs of the level below."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        columns, counts = _unpack(table, level, model.id_type, model.count_type)
        keys, first, place = distinct(gram_key(columns, len(counts)))
        counts = np.bincount(place, weights=counts, minlength=len(keys)).astype(np.int64)
        columns = [c[first] for c in columns]
        sharedfiles.save(model.folder, f"grams-{level}-{shard}.key", keys)
        sharedfiles.save(model.folder, f"grams-{level}-{shard}.n", counts.astype(model.count_type))
        context, _, place = distinct(gram_key(columns[:-1], len(keys)))
        stats = [np.bincount(place, weights=w, minlength=len(context)).astype(np.int64)
                 for w in (counts, counts == 1, counts == 2, counts == 3, counts == 4, counts > 4)]
        out = [_merged(pa.table(dict(zip(("ctx", "total", "n1", "n2", "n3", "n4", "more"), (pa.array(x) for x in (context.view(np.int64), *stats)), strict=True))))]
        if level > 1:  # every n-gram adds one to its suffix
            lower = Entries(level - 1, model.id_type, model.count_type, model.entries)
            last = model.counts_of(columns[-2].astype(np.int64)) if level > 2 else None
            batches = [*lower.add(columns[1:], model.shard_of(columns[1:], len(keys), last)), *lower.flush()]
            out += [_merged(pa.table(b)) for b in map(_as_dict, batches)]
        return pa.concat_tables(out)
    return blobs.groupBy("shard").applyInArrow(run, MERGED)


def _as_dict(batch: pa.RecordBatch) -> dict:
    return dict(zip(batch.schema.names, batch.columns, strict=True))


_MERGED = pa.schema([(n, {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}[t]) for n, t in (f.split() for f in MERGED.split(", "))])


def _merged(part: pa.Table) -> pa.Table:
    return pa.table([part.column(f.name).cast(f.type) if f.name in part.column_names else pa.nulls(len(part), f.type) for f in _MERGED], schema=_MERGED)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The discounts of counts 1, 2 and 3 or more."""
    if not (n1 and n2 and n3):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return d if all(0 <= x <= k for k, x in enumerate(d, 1)) else FALLBACK


def _write_contexts(contexts: DataFrame, model: Model) -> DataFrame:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        level, shard = key[0].as_py(), key[1].as_py()
        ctx = table.column("ctx").to_numpy().view(np.uint64)
        order = np.argsort(ctx)
        c = {n: table.column(n).to_numpy()[order].astype(np.float64) for n in ("total", "n1", "n2", "n3", "n4", "more")}
        d1, d2, d3 = model.discounts[level]
        back = (d1 * c["n1"] + d2 * c["n2"] + d3 * (c["n3"] + c["n4"] + c["more"])) / c["total"]
        for name, x in (("key", ctx[order]), ("total", c["total"]), ("back", back)):
            sharedfiles.save(model.folder, f"contexts-{level}-{shard}.{name}", x)
        return pa.table({"level": pa.array([level], pa.int32()), "shard": pa.array([shard], pa.int32()), "n": pa.array([len(ctx)])})
    # the shard is the unsigned key modulo the number of shards
    unsigned = F.pmod(F.pmod(F.shiftrightunsigned("ctx", 1), F.lit(model.context_shards)) * 2 + F.col("ctx").bitwiseAND(F.lit(1)), F.lit(model.context_shards))
    return contexts.withColumn("shard", unsigned.cast("int")).groupBy("level", "shard").applyInArrow(run, "level int, shard int, n long")


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER, entries: int = ENTRIES) -> Model:
    """Counts the texts of ``docs`` and writes the model's arrays."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    size, n_texts = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-(size // BYTES_A_TOKEN + n_texts) // entries))
    bits = int(shards - 1).bit_length()
    folder = sharedfiles.new_folder(spark, "ngrams")
    found = {r["shard"]: r for r in _vocabulary(texts, folder, bits, entries).collect()}  # one row a shard
    words = [found[s]["words"] if s in found else 0 for s in range(1 << bits)]
    offsets = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)
    tokens = sum(r["tokens"] for r in found.values())
    model = Model(folder, order, bits, offsets, tokens, n_texts, shards, entries, "<u4" if offsets[-1] + 2 < 2**32 else "<u8",
                  "<u4" if tokens < 2**32 else "<u8")
    contexts, above = None, None
    for level in range(order, 0, -1):
        rows = _count_grams(texts, model, level) if level > 1 or order == 1 else above
        if 1 < level < order:
            rows = rows.unionByName(above)
        merged = stage_table(_merge(rows, level, model))
        stats = merged.where("ctx IS NOT NULL").select(F.lit(level).alias("level"), "ctx", "total", "n1", "n2", "n3", "n4", "more")
        contexts = stats if contexts is None else contexts.unionByName(stats)
        above = merged.where("ctx IS NULL").select("level", "shard", "ids", "counts")
    sums = [F.sum(c).alias(c) for c in ("total", "n1", "n2", "n3", "n4", "more")]
    contexts = stage_table(contexts.groupBy("level", "ctx").agg(*sums))
    per_level = {r["level"]: r for r in contexts.groupBy("level").agg(F.count("*").alias("contexts"), *sums).collect()}  # one row a level
    model.discounts = {n: discounts(r["n1"], r["n2"], r["n3"], r["n4"]) for n, r in per_level.items()}
    model.context_shards = max([1, *(-(-r["contexts"] // entries) for r in per_level.values())])
    _write_contexts(contexts, model).count()
    return model


# ---------------------------------------------------------------- scoring
def probabilities(seq: Sequence, model: Model) -> np.ndarray:
    """The probability of each of the sequence's own tokens."""
    at = np.flatnonzero(seq.new)
    p = np.full(len(at), 1.0 / (model.words + 1))
    if not model.discounts:
        return p
    own, first, place = distinct(seq.ids[at].astype(np.uint64))
    for n in range(1, model.order + 1):
        some = np.flatnonzero(seq.depth[at] >= n - 1)
        columns = seq.grams(n, at[some])
        if n == 1:  # a word's own share doesn't hang on its context
            count = model.grams([own.astype(np.int64)], None)[place]
        else:
            count = model.grams(columns, seq.counts[at[some] - 1])
        if n == 2:
            before, _, where = distinct(columns[0].astype(np.uint64))
            total, back = (x[where] for x in model.contexts([before.astype(np.int64)], len(before)))
        else:
            total, back = model.contexts(columns[:-1], len(some)) if n > 1 else (x[:1] for x in model.contexts([], 1))
        discount = np.array([0.0, *model.discounts[n]])[np.minimum(count, 3)]
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(total > 0, np.maximum(count - discount, 0) / total, 0.0)
        p[some] = share + back * p[some]
    return p


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    (add-one unigrams) and ``score``, both log10 probabilities of the text.

    Without ``keep_text`` the text isn't among the columns, and so goes to the
    workers once and not back.
    """
    fields = T.StructType.fromDDL("n_tokens long, n_known long, train_tokens long, base_score double, score double")
    docs = without(docs, *fields.names)
    helper = unused(docs, "__text")
    rows = docs.withColumn(helper, F.col(text_col).cast("binary"))
    if not keep_text:
        docs, rows = docs.drop(text_col), rows.drop(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _some(batches):
            size = batch.num_rows
            n, known, base, total = np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(size)
            for seq in sequences(_texts(batch, helper), model):
                doc, count = seq.doc[seq.new], seq.counts[seq.new]
                n += np.bincount(doc, minlength=size)
                known += np.bincount(doc, weights=count > 0, minlength=size)
                base += np.bincount(doc, weights=np.log10((count + 1) / (model.tokens + model.words + 1)), minlength=size)
                total += np.bincount(doc, weights=np.log10(probabilities(seq, model)), minlength=size)
            yield extend(batch, {"n_tokens": pa.array(n.astype(np.int64)), "n_known": pa.array(known.astype(np.int64)),
                                 "train_tokens": pa.array(np.full(size, model.tokens)), "base_score": pa.array(base), "score": pa.array(total)},
                         drop=[helper])
    return map_batches(rows, run, T.StructType([*docs.schema, *fields]))
