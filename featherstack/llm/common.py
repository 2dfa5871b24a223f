"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def stage_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and reread it.

    Cuts the lineage like ``checkpoint()`` (a lost executor costs nothing that
    is already written), but columnar and compressed, so later stages read
    only the columns they need.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (any case)."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns the operators work on, the text as UTF-8 bytes."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))


def crc_mod(id_col: str, mod: int):
    """``crc32`` of the id written as text ('' for a NULL id), modulo ``mod`` (the held-out rule)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` of a function of a task's batches; the worker, which
    Spark uses again, gives Arrow's memory back when the task ends."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return df.mapInArrow(task, schema)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str) -> DataFrame:
    """``map_batches`` of a function from one record batch to one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out
    return map_batches(df, run, schema)


def row_slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes, so that what a worker makes of them stays small."""
    rows = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def extend(batch: pa.RecordBatch, columns: dict[str, pa.Array], drop: Sequence[str] = ()) -> pa.RecordBatch:
    """The batch with columns added (and some dropped)."""
    names = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + list(columns.values()),
                                      names=names + list(columns))


def binaries(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a binary column as bytes."""
    for v in column:
        yield v.as_py()


def mix64(x: np.ndarray) -> np.ndarray:
    """A full-avalanche mix of unsigned 64-bit integers (splitmix finaliser)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Runs of equal integer ``keys`` in sorted rows, each as one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and any(c[0] != x for c, x in zip(columns, last, strict=True))
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        last, begin = [c[-1] for c in columns], 0
        for cut in cuts:
            if begin < cut:
                held.append(batch.slice(begin, cut - begin))
            if cut < batch.num_rows and held:
                yield _one(held)
                held = []
            begin = cut
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
