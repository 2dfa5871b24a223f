"""Exact k-nearest-neighbour join by pivots and the triangle inequality.

1. A few base rows, chosen by a hash of their key, are pivots; every base row
   belongs to the cell of its nearest pivot (a Voronoi cell) and keeps its
   distance to it.
2. Of every cell the driver learns how many rows it holds, its smallest and
   largest distance and its first k distances: a few numbers a pivot.
3. A query row's distance to a base row of cell j is at most ``d(q, p_j) +
   d(o, p_j)``, so the k-th smallest of these sums bounds its k-th neighbour.
   It must visit the cells that can hold a closer row: not those that the
   bound rules out by ``|d(q, p_j) - d(o, p_j)|`` at the cell's smallest and
   largest distance, or by the plane between its own pivot and p_j.
4. Neighbouring cells are put together to blocks of at most ``block_rows`` rows,
   BLOCK_BYTES by default (a larger cell is cut into several), and the query
   rows that visit a block are cut into slices.  A query row goes once to each
   block in which it must visit a cell, a base row once to each slice of its
   block, and a task holds one block and streams one slice.  So for N queries
   among N rows the rows moved are N times the number of blocks and slices, not
   of cells.
5. A task takes a tile of queries through the cells of its block, the closest
   first: a matrix product says which rows can be within the k-th distance found
   so far, and only those are measured exactly.  Of base rows with one vector
   it keeps the first few keys, since no others can be among the nearest.
6. A window over at most k candidates a visit takes the final k.

Nothing is dropped: the bounds are widened by more than they can be rounded
by.  No pair is written, and pivots (at most MAX_PIVOTS vectors) are all that
is sent to the tasks.  Base rows without a vector or label, and query rows
without a vector, have no neighbours; nor has a query row without a key where
it is to be told from the base rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

MAX_PIVOTS = 1024
CELL_ROWS = 2_000  # base rows to a pivot
BLOCK_BYTES = 32 << 20  # of vectors, in double precision, that a task holds
PIECE_ROWS = 8_192  # rows of a cell that a tile meets at once
SHARES = 4  # blocks, and slices of queries, of a table that would fill fewer
MAX_TASKS = 10_000
TILE = 256  # query rows whose distances to a cell are in memory at once
MEASURED = 16_384  # pairs whose exact distances are computed at once
SPARE = 64  # rows of a query's own key that the lists of first distances leave room for
SLACK = 1e-9


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _type(df: DataFrame) -> str:
    return df.schema["__vec"].dataType.simpleString()


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances by expansion: good to about 1e-7 of the norms, for bounds only."""
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * x @ y.T
    return np.sqrt(np.maximum(d2, 0.0))


def _chain(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by its nearest that is left."""
    between, order = _distances(pivots, pivots), [0]
    for _ in range(len(pivots) - 1):
        between[:, order[-1]] = np.inf
        order.append(int(between[order[-1]].argmin()))
    return np.array(order)


@dataclass
class Cells:
    """What every task knows of the cells."""
    pivots: np.ndarray
    rows: np.ndarray
    nearest: np.ndarray  # smallest and largest distance to the pivot
    farthest: np.ndarray
    first: np.ndarray  # the first distances of each cell, then infinity
    need: int  # so many rows must be within the bound
    slack: float

    def bound(self, d: np.ndarray) -> np.ndarray:
        """An upper bound of each query's k-th neighbour distance from its distances to the pivots."""
        out = np.full(len(d), np.inf)
        for i, row in enumerate(d):
            sums = (row[:, None] + self.first).ravel()
            if len(sums) >= self.need:
                out[i] = np.partition(sums, self.need - 1)[self.need - 1]
        return out + self.slack

    def low(self, d: np.ndarray, own: np.ndarray, d_own: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """A lower bound of each query's distance to any row of ``cells``, from its
        distances to their pivots, its nearest pivot and the distance to it."""
        between = _distances(self.pivots[own], self.pivots[cells])
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(between > self.slack, (d * d - (d_own ** 2)[:, None]) / (2 * between), 0.0)
        return np.maximum.reduce([d - self.farthest[cells], self.nearest[cells] - d, plane])

    def visits(self, d: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Which cells each query must visit."""
        own = d.argmin(axis=1)
        low = self.low(d, own, d[np.arange(len(d)), own], np.arange(len(self.pivots)))
        return (self.rows > 0) & (low <= bound[:, None] + self.slack)

    def block_rows(self) -> int:
        return max(1, BLOCK_BYTES // (8 * max(1, self.pivots.shape[1])))

    def blocks(self, block_rows: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """The first block of each cell, how many blocks hold its rows, and the number of blocks."""
        block_rows = block_rows or self.block_rows()
        first, parts = np.zeros(len(self.rows), np.int64), np.ceil(self.rows / block_rows).astype(np.int64)
        n, held, room = 0, 0, 0
        for c in _chain(self.pivots) if len(self.pivots) else ():
            if parts[c] > 1:
                first[c], n = n, n + parts[c]
            elif parts[c]:
                if self.rows[c] > room:
                    held, room, n = n, block_rows, n + 1
                first[c], room = held, room - self.rows[c]
        return first, parts, int(n)


def fit_cells(base: DataFrame, k: int, cell_rows: int = CELL_ROWS, own: int = 0) -> tuple[DataFrame, Cells]:
    """(key, label, vector, cell, distance) of the base rows ``(__bk, __lab, __vec)``, and the cells;
    up to ``own`` rows of a query's own key do not count for its bound."""
    depth = k + min(own, SPARE)
    rows = base.select("__bk", "__lab", "__vec").where("__vec IS NOT NULL AND __lab IS NOT NULL AND __bk IS NOT NULL")
    n = rows.count()
    wanted = min(MAX_PIVOTS, max(1, math.ceil(n / cell_rows)))
    chosen = rows.orderBy(F.xxhash64("__bk"), "__bk").limit(wanted).select("__vec").collect()
    pivots = np.array([r[0] for r in chosen], dtype=np.float64) if chosen else np.zeros((0, 0))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column("__vec"))
                cell = _distances(x, pivots).argmin(axis=1)
                d = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d)],
                                                 names=[*batch.schema.names, "__cell", "__dp"])
    placed = materialize(rows.mapInArrow(place, f"__bk long, __lab long, __vec {_type(rows)}, __cell int, __dp double"))
    size, near, far = np.zeros(len(pivots)), np.full(len(pivots), np.inf), np.zeros(len(pivots))
    first = np.full((len(pivots), depth), np.inf)
    for r in placed.groupBy("__cell").agg(F.count(F.lit(1)), F.min("__dp"), F.max("__dp")).collect():
        size[r[0]], near[r[0]], far[r[0]] = r[1], r[2], r[3]
    rank = F.row_number().over(Window.partitionBy("__cell").orderBy("__dp"))
    for r in placed.select("__cell", "__dp", rank.alias("__rn")).where(F.col("__rn") <= depth).collect():
        first[r["__cell"], r["__rn"] - 1] = r["__dp"]
    scale = float(np.sqrt((pivots * pivots).sum(1)).max(initial=0.0) + far.max(initial=0.0))
    return placed, Cells(pivots, size, near, far, first, k + own, SLACK + 1e-6 * scale)


def _visited(part: pa.RecordBatch, cells: Cells, first: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, block) of the blocks that the queries of ``part`` visit; bounds and nearest pivots of the queries."""
    d = _distances(_vectors(part.column("__vec")), cells.pivots)
    bound = cells.bound(d)
    q, cell = np.nonzero(cells.visits(d, bound))
    n = parts[cell]
    block = np.repeat(first[cell] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    blocks = int((first + parts).max(initial=1))
    return *divmod(np.unique(np.repeat(q, n) * blocks + block), blocks), bound, d.argmin(axis=1)


def _tiles(batches: Iterator[pa.RecordBatch], cells: Cells) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows if len(cells.pivots) else 0, TILE):
            yield batch.slice(begin, TILE)


def visits(query: DataFrame, cells: Cells, block_rows: int | None = None) -> DataFrame:
    """(block, key, vector, bound, own cell): a row for each block that a query ``(__qk, __vec)`` visits."""
    first, parts, _ = cells.blocks(block_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _tiles(batches, cells):
            q, block, bound, own = _visited(part, cells, first, parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.astype(np.int32)), part.column("__qk").take(pa.array(q)), part.column("__vec").take(pa.array(q)),
                 pa.array(bound[q]), pa.array(own[q].astype(np.int32))], names=["__block", "__qk", "__vec", "__bound", "__cell"])
    rows = query.select("__qk", "__vec").where("__vec IS NOT NULL")
    return rows.mapInArrow(run, f"__block int, __qk long, __vec {_type(rows)}, __bound double, __cell int")


def visitors(query: DataFrame, cells: Cells, block_rows: int | None = None) -> np.ndarray:
    """How many queries visit each block."""
    first, parts, n = cells.blocks(block_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for part in _tiles(batches, cells):
            total += np.bincount(_visited(part, cells, first, parts)[1], minlength=n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(total)], names=["__block", "__n"])
    out = np.zeros(n, np.int64)
    for r in query.select("__vec").where("__vec IS NOT NULL").mapInArrow(run, "__block int, __n long").groupBy("__block").agg(F.sum("__n")).collect():
        out[r[0]] = r[1]
    return out


class Block:
    """A block of base rows: cell by cell, each in the order of the distance to its pivot."""

    def __init__(self, parts: list[pa.RecordBatch], cells: Cells, k: int, other: bool):
        t = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        cell, keys, x = t.column("__cell").to_numpy(), t.column("__k").to_numpy(), _vectors(t.column("__vec"))
        dp = t.column("__d").to_numpy()
        at = self._first_copies(x, keys, k, other)
        at = at[np.lexsort((dp[at], cell[at]))]
        self.info, self.k, self.other = cells, k, other
        self.dp, self.keys, self.labels, self.x = dp[at], keys[at], t.column("__lab").to_numpy()[at], x[at]
        self.x2 = (self.x * self.x).sum(1)
        self.w = np.hstack([-2.0 * self.x, self.x2[:, None]])
        self.cells, begin = np.unique(cell[at], return_index=True)
        ends = zip(begin.tolist(), [*begin[1:].tolist(), len(at)], strict=True)
        self.pieces = [[(a, min(a + PIECE_ROWS, e)) for a in range(b, e, PIECE_ROWS)] for b, e in ends]
        self.by_key = np.argsort(self.keys, kind="stable")

    @staticmethod
    def _first_copies(x: np.ndarray, keys: np.ndarray, k: int, other: bool) -> np.ndarray:
        """Places of the rows, of each vector the first k by key and as many more as one key has rows."""
        raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
        _, vector = np.unique(raw, return_inverse=True)
        most = int(np.unique(keys, return_counts=True)[1].max()) if other else 0
        order = np.lexsort((keys, vector))
        new = np.r_[True, np.diff(vector[order]) > 0]
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        return order[rank < k + most]

    def _own(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of the base rows with a query's own key."""
        sorted_keys = self.keys[self.by_key]
        lo, hi = np.searchsorted(sorted_keys, ids), np.searchsorted(sorted_keys, ids, side="right")
        n = hi - lo
        return np.repeat(np.arange(len(ids)), n), self.by_key[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def nearest(self, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, place, distance) of each query's k nearest by (distance, key) among the rows that can be within its bound."""
        c, k, reach = self.info, self.k, bound.copy()
        q2, qa = (q * q).sum(1), np.hstack([q, np.ones((len(q), 1))])
        d = _distances(q, c.pivots[self.cells])
        low = c.low(d, own, np.sqrt(((q - c.pivots[own]) ** 2).sum(1)), self.cells)
        mine, place = self._own(ids) if self.other else (np.zeros(0, int), np.zeros(0, int))
        found = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        for j, (begin, end) in ((j, ends) for j in np.argsort(d.mean(axis=0), kind="stable") for ends in self.pieces[j]):
            rows = np.flatnonzero(low[:, j] <= reach + c.slack)
            if not len(rows):
                continue
            r = reach[rows]
            lo = begin + np.searchsorted(self.dp[begin:end], (d[rows, j] - r).min() - c.slack)
            hi = begin + np.searchsorted(self.dp[begin:end], (d[rows, j] + r).max() + c.slack, side="right")
            if lo >= hi:
                continue
            h = qa[rows] @ self.w[lo:hi].T  # squared distances less the query's square
            inside = (place >= lo) & (place < hi) & (low[mine, j] <= reach[mine] + c.slack)
            h[np.searchsorted(rows, mine[inside]), place[inside] - lo] = np.inf
            # rows that the expansion puts within rounding of the k-th are measured exactly, so all ties are seen
            fuzz = 4e-9 * (q2[rows] + self.x2[lo:hi].max())
            top = np.minimum(r * r - q2[rows] + fuzz, np.finfo(float).max)
            near = h <= top[:, None]
            if np.count_nonzero(near) > 4 * k * len(rows):
                many = np.flatnonzero(near.sum(axis=1) > 4 * k)
                few = np.partition(h[many], k - 1, axis=1)[:, k - 1] + fuzz[many]
                near[many] = h[many] <= np.minimum(top[many], few)[:, None]
            i, p = divmod(np.flatnonzero(near), hi - lo)
            if len(i):
                i, p = rows[i], p + lo
                found = self._best(*(np.concatenate(z) for z in zip(found, (i, p, self._measure(q, i, p)), strict=True)))
                last = np.flatnonzero(np.bincount(found[0], minlength=len(q)) == k)
                reach[last] = np.minimum(reach[last], found[2][np.searchsorted(found[0], last, side="right") - 1])
        return found

    def _measure(self, q: np.ndarray, i: np.ndarray, p: np.ndarray) -> np.ndarray:
        parts = [slice(a, a + MEASURED) for a in range(0, len(i), MEASURED)]
        return np.concatenate([np.sqrt(((q[i[a]] - self.x[p[a]]) ** 2).sum(1)) for a in parts])

    def _best(self, i: np.ndarray, p: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first k of each query by (distance, key), in the order of the queries."""
        order = np.lexsort((self.keys[p], d, i))
        i = i[order]
        start = np.maximum.accumulate(np.where(np.r_[True, np.diff(i) > 0], np.arange(len(i)), 0))
        keep = np.arange(len(i)) - start < self.k
        return i[keep], p[order][keep], d[order][keep]


def knn_neighbours(base: DataFrame, query: DataFrame, bkey: str, qkey: str, vec: str, label: str, k: int,
                   block_rows: int | None = None, cell_rows: int = CELL_ROWS, other: bool = False) -> DataFrame:
    """The k nearest base rows of every query row: ``(__q, __b, __d, __y, rn)``;
    ties on distance go to the smaller base key.  With ``other``, a base row
    with the query's own key is not its neighbour."""
    single = all(df.schema[vec].dataType.simpleString() == "array<float>" for df in (base, query))
    vector = F.col(vec).cast("array<float>" if single else "array<double>").alias("__vec")
    rows = base.select(F.col(bkey).cast("long").alias("__bk"), F.col(label).cast("long").alias("__lab"), vector)
    asking = query.select(F.col(qkey).cast("long").alias("__qk"), vector)
    own = 0
    if other:
        asking = asking.where("__qk IS NOT NULL")
        own = rows.where("__bk IS NOT NULL").groupBy("__bk").count().agg(F.max("count")).first()[0] or 0
    placed, cells = fit_cells(rows, k, cell_rows, own)
    block_rows = min(block_rows or cells.block_rows(), max(cell_rows, math.ceil(cells.rows.sum() / SHARES)))
    first, parts, _ = cells.blocks(block_rows)
    asked_of = visitors(asking, cells, block_rows)
    slice_rows = min(SHARES * block_rows, max(cell_rows, math.ceil(asked_of.max(initial=0) / SHARES)))
    slices = np.ceil(asked_of / slice_rows).astype(np.int64)
    tasks = min(MAX_TASKS, max(1, int(slices.sum())))

    def of(values: np.ndarray, place: str) -> F.Column:
        return F.element_at(F.array(*[F.lit(int(v)) for v in values] or [F.lit(1)]), F.col(place) + 1)
    block = of(first, "__cell") + F.pmod(F.xxhash64("__bk"), of(np.maximum(parts, 1), "__cell"))
    left = placed.withColumn("__block", block.cast("int")).where(of(slices, "__block") > 0).select(
        "__block", F.explode(F.sequence(F.lit(0), of(slices, "__block") - 1)).alias("__slice"), F.lit(0).alias("__kind"), "__cell",
        F.col("__bk").alias("__k"), "__lab", "__vec", F.col("__dp").alias("__d"))
    right = visits(asking, cells, block_rows).select(
        "__block", F.pmod(F.xxhash64("__qk"), of(np.maximum(slices, 1), "__block")).cast("int").alias("__slice"), F.lit(1).alias("__kind"), "__cell",
        F.col("__qk").alias("__k"), F.lit(None).cast("long").alias("__lab"), "__vec", F.col("__bound").alias("__d"))
    task = of(np.cumsum(slices) - slices, "__block") + F.col("__slice")
    groups = (left.unionByName(right).withColumn("__task", task).repartitionById(tasks, F.pmod("__task", F.lit(tasks)).cast("int"))
              .sortWithinPartitions("__task", "__kind", "__cell", "__k"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("__task", "__kind")]
            cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1 if batch.num_rows else np.zeros(0, int)
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if begin == end:
                    continue
                part, now = batch.slice(begin, end - begin), int(columns[0][begin])
                if now != key:
                    key, held, block = now, [], None
                if columns[1][begin] == 0:
                    held.append(part)
                elif held or block is not None:
                    if block is None:
                        block, held = Block(held, cells, k, other), []
                    for tile in _tiles([part], cells):
                        yield answer(block, tile)

    def answer(block: Block, part: pa.RecordBatch) -> pa.RecordBatch:
        ids = part.column("__k").to_numpy(zero_copy_only=False)
        q, at, d = block.nearest(ids, _vectors(part.column("__vec")), part.column("__d").to_numpy(), part.column("__cell").to_numpy())
        return pa.RecordBatch.from_arrays([part.column("__k").take(pa.array(q)), pa.array(block.keys[at]), pa.array(d), pa.array(block.labels[at])],
                                          names=["__q", "__b", "__d", "__y"])
    found = groups.mapInArrow(run, "__q long, __b long, __d double, __y long")
    w = Window.partitionBy("__q").orderBy("__d", "__b")
    return found.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def knn_score(base: DataFrame, query: DataFrame, bkey: str, qkey: str, vec: str, label: str, k: int,
              block_rows: int | None = None, cell_rows: int = CELL_ROWS, other: bool = False) -> DataFrame:
    """Distance-weighted vote (weights 1/d; an exact match takes all the
    weight): predicted label and its weight share."""
    nb = knn_neighbours(base, query, bkey, qkey, vec, label, k, block_rows, cell_rows, other)
    has_zero = F.max((F.col("__d") == 0).cast("int")).over(Window.partitionBy("__q"))
    weight = F.when(has_zero == 1, (F.col("__d") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("__d")))
    votes = nb.withColumn("__w", weight).groupBy("__q", "__y").agg(F.sum("__w").alias("__vw"))
    total = F.sum("__vw").over(Window.partitionBy("__q"))
    best = F.row_number().over(Window.partitionBy("__q").orderBy(F.col("__vw").desc(), F.col("__y")))
    ranked = votes.withColumn("__share", F.col("__vw") / total).withColumn("__r", best).where(F.col("__r") == 1)
    return ranked.select(F.col("__q").alias(qkey), F.col("__y").alias("knn_label"), F.col("__share").alias("knn_share"))
