"""Line dedup: a sharded minimal perfect hash over all distinct lines.

Lines are hashed to 128 bits.  Per-document distinct hashes are counted with
map-side combining, so the commonest line is one row per map task, and dealt
into shards by the leading bits of the hash.  Each shard's task builds a minimal
perfect hash of its keys that indexes two arrays, a 32-bit fingerprint and the
number of documents, which stops at ``min_docs`` and so takes one byte as a
rule, and writes them into the shared folder: about 6 bytes a distinct line.

Documents then probe the arrays in place, one probe a line, in the shard that
its hash names; workers memory-map the shards and hold the pages they touch.
The count that is found decides.  No line crosses a shuffle again, no document
moves, nothing is sent to or through the driver, and one pass does it whatever
the size of the index.

Cases: NULL or empty text is one empty line; every row is a document, rows that
share an id or a text included; an empty table gives an empty result; a NULL id
is kept as it is; a very long text or line is whole; columns of the input that
carry an output's name are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sharedfiles
from .common import extend, map_arrow, map_batches, row_slices, without
from .mphf import PerfectHash

SPACE = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 2 << 20  # text whose lines are objects at once
SHARD_BYTES = 32 << 20  # text whose distinct lines are a shard, one in about 30 bytes at most as a rule


def line_key(line: bytes) -> bytes:
    """The line stripped of ASCII white space, A-Z lower-cased."""
    return line.strip(SPACE).lower()


def _digests(lines: list[bytes], min_chars: int) -> list[bytes]:
    """A 16-byte hash per line; empty where the key is too short to count."""
    keys = [x.strip(SPACE) for x in lines]
    if min_chars > 1:
        keys = [k if len(k.decode("utf-8", "replace")) >= min_chars else b"" for k in keys]
    return [xxhash.xxh3_128_digest(k) if k else b"" for k in keys]


def _lines(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def count_lines(docs: DataFrame, text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(lo, hi, n): each distinct line's 128-bit hash and the documents that hold it."""
    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: Counter[bytes] = Counter()
        for text in batch.column(0):
            seen.update({*_digests(_lines((text.as_py() or b"").lower()), min_chars)})
        seen.pop(b"", None)
        lo, hi = _halves(list(seen))
        return pa.RecordBatch.from_arrays([pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)),
                                           pa.array(np.fromiter(seen.values(), np.int64, len(seen)))], names=["lo", "hi", "n"])
    text = docs.select(F.col(text_col).cast("binary").alias("text"))
    return map_arrow(text, count, "lo long, hi long, n long").groupBy("lo", "hi").agg(F.sum("n").alias("n"))


def _shard(lo: np.ndarray, bits: int) -> np.ndarray:
    return (lo >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(lo), np.int64)


def build_index(counts: DataFrame, folder: str, bits: int, min_docs: int) -> DataFrame:
    """Writes the index of every shard of (lo, hi, n); returns (shard, keys)."""
    def build(key: tuple, rows: pa.Table) -> pa.Table:
        lo, hi = (rows.column(c).to_numpy().view(np.uint64) for c in ("lo", "hi"))
        table = PerfectHash.build(lo, hi)
        at = table.index(lo, hi)
        prints, n = np.empty(len(lo), "<u4"), np.empty(len(lo), _count_type(min_docs))
        prints[at], n[at] = hi.astype("<u4"), np.minimum(rows.column("n").to_numpy(), min_docs)
        for name, array in {**table.arrays(), "prints": prints, "n": n}.items():
            sharedfiles.save(folder, f"{key[0].as_py()}.{name}", array)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "keys": pa.array([len(lo)])})
    shard = F.shiftrightunsigned("lo", 64 - bits) if bits else F.lit(0).cast("long")
    return counts.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "shard long, keys long")


def _count_type(min_docs: int) -> str:
    return "<u1" if min_docs < 256 else "<u4" if min_docs < 2**32 else "<u8"


@lru_cache(maxsize=1024)
def _index(folder: str, shard: int, count_type: str) -> tuple[PerfectHash, np.ndarray, np.ndarray]:
    """A shard's hash, fingerprints and counts, memory-mapped."""
    bits, ranks, words, rest = (sharedfiles.load(folder, f"{shard}.{n}", t) for n, t in (("bits", "<u8"), ("ranks", "<i8"), ("words", "<i8"), ("rest", "<u8")))
    prints = sharedfiles.load(folder, f"{shard}.prints", "<u4")
    return PerfectHash.of(bits, ranks, words, rest, len(prints)), prints, sharedfiles.load(folder, f"{shard}.n", count_type)


def document_counts(folder: str, bits: int, min_docs: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """How many documents hold each line, ``min_docs`` at most; 0 for a line that is not in the index."""
    out = np.zeros(len(lo), np.int64)
    shard = _shard(lo, bits)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        table, prints, n = _index(folder, int(shard[part[0]]), _count_type(min_docs))
        if len(prints):
            at = table.index(lo[part], hi[part])
            known = np.flatnonzero(at >= 0)
            known = known[prints[at[known]] == hi[part[known]].astype("<u4")]
            out[part[known]] = n[at[known]]
    return out


def drop_common_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with ``text_col`` freed of every line whose key is in ``min_docs``
    documents or more, and the columns ``n_lines`` and ``n_dropped``."""
    docs = without(docs, "n_lines", "n_dropped")
    order = docs.columns
    raw = docs.withColumn(text_col, F.col(text_col).cast("binary"))
    size = raw.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = int(-(-size // shard_bytes)).bit_length() if size > shard_bytes else 0
    folder = sharedfiles.new_folder(docs.sparkSession, "lines")
    build_index(count_lines(docs, text_col, min_chars), folder, bits, min_docs).count()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.as_py() for t in batch.column(text_col)]
        parts = [_lines(t) for t in texts]
        digests = [d for t in texts for d in _digests(_lines((t or b"").lower()), min_chars)]
        counted = np.fromiter(map(bool, digests), bool, len(digests))
        common = np.zeros(len(digests), dtype=bool)
        common[counted] = document_counts(folder, bits, min_docs, *_halves([d for d in digests if d])) >= min_docs
        total = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(total)
        dropped = np.array([int(common[e - n:e].sum()) for e, n in zip(ends, total, strict=True)], np.int64)
        kept = [b"\n".join(x for x, c in zip(p, common[e - n:e], strict=True) if not c) if d else t
                for t, p, e, n, d in zip(texts, parts, ends, total, dropped, strict=True)]
        done = batch.set_column(batch.schema.get_field_index(text_col), text_col, pa.array(kept, pa.binary()))
        return extend(done, {"n_lines": pa.array(total), "n_dropped": pa.array(dropped)})
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(cut, row_slices(batch, SLICE_BYTES))
    done = map_batches(raw, run, T.StructType([*raw.schema, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]))
    return done.withColumn(text_col, F.col(text_col).cast("string")).select(*order, "n_lines", "n_dropped")
