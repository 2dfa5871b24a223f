"""Grouped pandas apply in two phases: the escape hatch for per-group logic that
built-in expressions cannot state.

A group of any size is cut into parts of about ``rows_per_part`` rows; a
``partial`` function reduces each part to a few rows and ``merge`` reduces a
group's partial rows to its result, so no task needs a whole group.

Functions of one group cost a call, and a pandas frame, for each group.  With
millions of small groups functions of ``many`` groups are the way: they get
frames of up to ``rows_per_part`` rows with all the keys that these happen to
have, so calls grow with the rows, and only partial rows are shuffled, once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PandasFn = Callable[[pd.DataFrame], pd.DataFrame]
ROWS_PER_PART = 100_000
# integers stay integers beside NULLs
NULLABLE = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}


def grouped_apply(df: DataFrame, key: str, partial: PandasFn, merge: PandasFn, partial_schema: str, schema: str,
                  rows_per_part: int = ROWS_PER_PART, many: bool = False) -> DataFrame:
    """``merge`` over the ``partial`` results of each group's parts.

    Both get a pandas frame of rows with one ``key`` or, with ``many``, of
    rows with any number of keys (an integer or string column), and then
    return rows for each of them; integers then have pandas' nullable types.
    ``merge`` gets all partial rows of a key at once.  The partial rows must
    carry ``key``.  Rows with a NULL key form one group.
    """
    if many:
        return _many(df, key, partial, merge, partial_schema, schema, rows_per_part)
    parts = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / rows_per_part).alias("__parts")).withColumnRenamed(key, "__key")
    cut = df.join(parts, F.col(key).eqNullSafe(F.col("__key"))).withColumn(
        "__part", F.pmod(F.xxhash64(*df.columns), F.col("__parts"))).drop("__key", "__parts")

    def one_part(pdf: pd.DataFrame) -> pd.DataFrame:
        return partial(pdf.drop(columns="__part"))
    return cut.groupBy(key, "__part").applyInPandas(one_part, partial_schema).groupBy(key).applyInPandas(merge, schema)


def _many(df: DataFrame, key: str, partial: PandasFn, merge: PandasFn, partial_schema: str, schema: str, rows_per_part: int) -> DataFrame:
    def applied(fn: PandasFn, ddl: str) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
        out = to_arrow_schema(T.StructType.fromDDL(ddl))

        def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if table.num_rows:
                got = fn(table.to_pandas(types_mapper=NULLABLE.get))
                yield from pa.Table.from_pandas(got, schema=out, preserve_index=False).to_batches()
        return run
    part, whole = applied(partial, partial_schema), applied(merge, schema)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, rows_per_part):
                piece = batch.slice(begin, rows_per_part)
                if size + piece.num_rows > rows_per_part and held:
                    yield from part(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(piece)
                size += piece.num_rows
        if held:
            yield from part(pa.Table.from_batches(held))

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the partial rows of the last key, which may go on in the next batch
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                table = table if held is None else pa.concat_tables([held, table])
                keys = table.column(key)
                same = pc.is_null(keys) if not keys[-1].is_valid else pc.fill_null(pc.equal(keys, keys[-1]), False)
                begin = pc.index(same, True).as_py()
                yield from whole(table.slice(0, begin))
                held = table.slice(begin)
        if held is not None:
            yield from whole(held)
    dealt = df.mapInArrow(parts, partial_schema).repartition(F.col(key)).sortWithinPartitions(key)
    return dealt.mapInArrow(groups, schema)
