"""Hard-negative mining: for anchors and their best positives, the best rows of
another label whose score lies in a window below the positive's.

A score is the inner product of two integer vectors.  Anchors are dealt into
blocks of about ANCHORS by hash, and each block gets a spanning tree (Prim's,
by Euclidean distance).  All rows are dealt into groups of about ROWS, and a
task takes one block of anchors with one group of rows: it scores the tree's
root, and for every further anchor the score at its parent, plus or minus the
length of the edge times the row's norm, bounds the score:

    |<x, child> - <x, parent>| = |<x, child - parent>| <= |x| * |child - parent|

Only rows whose bounds overlap the anchor's window are scored; what the others
keep is their bounds, which go on to the anchor's children.  The window of the
search for positives begins at the worst of the best positives so far; that of
the search for negatives is what the positives allow, and narrows as soon as
every positive has its negatives.  Bounds are widened by more than they can be
rounded by, so nothing is lost; scores are exact.

A task streams its rows and holds one slice of them with one block of anchors;
it hands on a few rows for each anchor, and the best of these are taken at the
end.  No label, hot or not, is gathered anywhere.

Cases: a row takes no part if its id, label or vector is NULL, if a component
is NULL or not finite, or if its integer norm is 2**31 or more (its scores may
not fit 63 bits); vectors of different lengths are not compared; rows that
share an id are rows of their own, but never positives or negatives of an
anchor with that id, and of the anchors with one id the one with the smallest
label and vector mines; ties in score go to the smaller id; an anchor without
positives, or a positive without negatives, gives no rows; an empty table
gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, map_arrow, map_batches, stage_table

ANCHORS = 256  # anchors of a tree
ROWS = 16_384  # rows that one task meets a tree with
SLICE = 2048  # rows whose bounds are held at once
EXACT = 2.0**53  # products of norms below this are exact in doubles


def quantised(vectors: DataFrame, id_col: str, label: str | Column, vector_col: str, scale: float = 256.0) -> DataFrame:
    """(id, label, dim, v): the rows that take part, each component as ``floor(scale * x)``, 32-bit."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                          F.col(vector_col).alias("v")).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("v")
        size = pc.list_value_length(column).to_numpy().astype(np.int64)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a NULL component is NaN
        with np.errstate(invalid="ignore", over="ignore"):
            values = np.floor(values * scale)
            squares = np.where(np.isfinite(values), np.minimum(np.abs(values), 2.0**40) ** 2, 2.0**80)
        ends, some = np.cumsum(size), size > 0
        norm2 = np.zeros(len(size))
        if some.any():
            norm2[some] = np.add.reduceat(squares, (ends - size)[some])
        ok = norm2 < 2.0**62
        packed = np.where(np.abs(values) < 2.0**31, values, 0).astype("<i4")
        out = [packed[e - n:e].tobytes() for e, n in zip(ends[ok].tolist(), size[ok].tolist(), strict=True)]
        keep = pa.array(ok)
        return pa.RecordBatch.from_arrays([batch.column("id").filter(keep), batch.column("label").filter(keep),
                                           pa.array(size[ok].astype(np.int32)), pa.array(out, pa.binary())], names=["id", "label", "dim", "v"])
    return map_arrow(rows, run, "id long, label long, dim int, v binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), "<i4").astype(np.int64).reshape(len(column), dim)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): rows in the order in which Prim's algorithm adds
    them, the place of each one's parent in that order, the edge's length."""
    x = x.astype(np.float64)
    near = np.full(len(x), np.inf)
    link, order = np.zeros(len(x), np.int64), [0]
    parent, edge = [-1], [0.0]
    while len(order) < len(x):
        d = np.sqrt(((x - x[order[-1]]) ** 2).sum(axis=1))
        closer = d < near
        near[closer], link[closer] = d[closer], len(order) - 1
        near[order[-1]] = -1.0  # in the tree
        k = int(np.argmin(np.where(near < 0, np.inf, near)))
        order.append(k)
        parent.append(int(link[k]))
        edge.append(float(near[k]))
    return np.array(order), np.array(parent), np.array(edge)


def plant(anchors: DataFrame) -> DataFrame:
    """(dim, a, place, parent, edge, id, label, v): the trees of all blocks ``a`` of anchors."""
    rows = anchors.repartition("dim", "a").sortWithinPartitions("dim", "a", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, ["dim", "a"]):
            order, parent, edge = spanning_tree(_matrix(block.column("v"), block.column("dim")[0].as_py()))
            block = block.take(pa.array(order))
            yield pa.RecordBatch.from_arrays([block.column("dim"), block.column("a"), pa.array(np.arange(len(order), dtype=np.int32)),
                                              pa.array(parent.astype(np.int32)), pa.array(edge), block.column("id"), block.column("label"),
                                              block.column("v")], names=["dim", "a", "place", "parent", "edge", "id", "label", "v"])
    return map_batches(rows, run, "dim int, a int, place int, parent int, edge double, id long, label long, v binary")


@dataclass
class Tree:
    """A block of anchors in tree order; ``wants`` holds each one's (positive score, positive id) list."""
    x: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    wants: list[list[tuple[int, int]]]
    scored: int = 0  # scores taken, of ``seen`` pairs of an anchor and a row
    seen: int = 0
    last: np.ndarray = field(init=False)

    def __post_init__(self):
        self.reach = _norms(self.x).max(initial=0.0)
        self.last = np.zeros(len(self.ids), np.int64)  # the last child of each anchor
        np.maximum.at(self.last, self.parent[1:], np.arange(1, len(self.ids)))

    def walk(self, x: np.ndarray, window: Callable[[int], tuple[float, float, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, scores) for each anchor: of the rows that its window
        (lowest, highest, which rows may) allows, all whose score can lie in it."""
        norm = _norms(x)
        exact = self.reach * norm.max(initial=0.0) < EXACT
        rows, anchors = (x.astype(np.float64), self.x.astype(np.float64)) if exact else (x, self.x)
        slack = 1.0 + norm * self.reach * 2.0**-48
        low: dict[int, np.ndarray] = {}
        high: dict[int, np.ndarray] = {}
        for k, up in enumerate(self.parent.tolist()):
            least, most, may = window(k)
            if up < 0:
                at = np.arange(len(x))
                lo, hi = np.empty(len(x)), np.empty(len(x))
            else:
                reach = self.edge[k] * norm * (1 + 1e-9) + slack
                lo, hi = low[up] - reach, high[up] + reach
                at = np.flatnonzero(may & (hi >= least) & (lo <= most))
                if self.last[up] == k:
                    del low[up], high[up]
            score = (rows[at] @ anchors[k]).astype(np.int64)
            lo[at] = hi[at] = score
            if self.last[k] > k:
                low[k], high[k] = lo, hi
            self.scored += len(at)
            self.seen += len(x)
            hit = may[at] & (score >= least) & (score <= most)
            yield k, at[hit], score[hit]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by score, then the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def least_score(positive: int, percent: int) -> int:
    """The smallest score s with ``percent * positive <= 100 * s``."""
    return -(-percent * positive // 100)


class Positives:
    """The first ``k`` rows of each anchor's label."""

    def __init__(self, tree: Tree, k: int):
        self.tree, self.k = tree, k
        self.scores, self.found = [np.zeros(0, np.int64) for _ in tree.ids], [np.zeros(0, np.int64) for _ in tree.ids]

    def meet(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        def window(a: int):
            worst = self.scores[a][-1] if len(self.scores[a]) == self.k else -np.inf
            return worst, np.inf, (labels == self.tree.labels[a]) & (ids != self.tree.ids[a])
        for a, at, score in self.tree.walk(x, window):
            scores, found = np.concatenate([self.scores[a], score]), np.concatenate([self.found[a], ids[at]])
            order = best(scores, found, self.k)
            self.scores[a], self.found[a] = scores[order], found[order]

    def rows(self) -> Iterator[tuple[int, int, int, int, int]]:
        for a, anchor in enumerate(self.tree.ids.tolist()):
            for s, i in zip(self.scores[a].tolist(), self.found[a].tolist(), strict=True):
                yield anchor, i, s, i, s


class Negatives:
    """For each positive of each anchor the first ``k`` rows of another label in its window."""

    def __init__(self, tree: Tree, k: int, low: int, high: int):
        self.tree, self.k = tree, k
        self.windows = [[(least_score(s, low), high * s // 100) for s, _ in w] for w in tree.wants]
        empty = np.zeros(0, np.int64)
        self.scores, self.found = ([[empty] * len(w) for w in tree.wants] for _ in range(2))

    def meet(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        def window(a: int):
            if not self.windows[a]:
                return np.inf, -np.inf, np.zeros(len(ids), dtype=bool)
            least = min(max(w[0], int(s[-1])) if len(s) == self.k else w[0] for w, s in zip(self.windows[a], self.scores[a], strict=True))
            return least, max(w[1] for w in self.windows[a]), (labels != self.tree.labels[a]) & (ids != self.tree.ids[a])
        for a, at, score in self.tree.walk(x, window):
            for p, (least, most) in enumerate(self.windows[a] if len(at) else ()):
                fits = (score >= least) & (score <= most)
                scores, found = np.concatenate([self.scores[a][p], score[fits]]), np.concatenate([self.found[a][p], ids[at[fits]]])
                order = best(scores, found, self.k)
                self.scores[a][p], self.found[a][p] = scores[order], found[order]

    def rows(self) -> Iterator[tuple[int, int, int, int, int]]:
        for a, anchor in enumerate(self.tree.ids.tolist()):
            for p, (score, positive) in enumerate(self.tree.wants[a]):
                for s, i in zip(self.scores[a][p].tolist(), self.found[a][p].tolist(), strict=True):
                    yield anchor, positive, score, i, s


FOUND = "anchor_id long, positive_id long, positive_score long, id long, score long"


def _search(trees: DataFrame, rows: DataFrame, sizes: DataFrame, make: Callable[[Tree], Positives | Negatives]) -> DataFrame:
    """What ``make(tree)`` finds in each cell (block of anchors, group of rows)."""
    sizes = sizes.select("dim", "blocks", "parts")
    left = trees.join(sizes, "dim").select("dim", "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("g"), F.lit(0).alias("kind"),
                                           "place", "parent", "edge", "wants", "id", "label", "v")
    right = rows.join(sizes, "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("a"),
                                           F.pmod(F.xxhash64("id", F.lit("group")), "parts").cast("int").alias("g"), F.lit(1).alias("kind"),
                                           F.lit(0).alias("place"), F.lit(0).alias("parent"), F.lit(0.0).alias("edge"),
                                           F.lit(None).cast(trees.schema["wants"].dataType).alias("wants"), "id", "label", "v")
    cells = left.unionByName(right).repartition("dim", "a", "g").sortWithinPartitions("dim", "a", "g", "kind", "place")

    def out(search: Positives | Negatives | None) -> Iterator[pa.RecordBatch]:
        if search is not None and (found := list(search.rows())):
            names = [f.split()[0] for f in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, planted, search = None, [], None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("dim", "a", "g", "kind")]
            cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                part, now = batch.slice(begin, end - begin), tuple(int(c[begin]) for c in columns[:3])
                if now != key:
                    yield from out(search)
                    key, planted, search = now, [], None
                if columns[3][begin] == 0:
                    planted.append(part)
                elif planted:
                    search = search or make(_tree(planted, now[0]))
                    for first in range(0, len(part), SLICE):
                        some = part.slice(first, SLICE)
                        search.meet(_matrix(some.column("v"), now[0]), some.column("id").to_numpy(), some.column("label").to_numpy())
        yield from out(search)
    return map_batches(cells, run, FOUND)


def _tree(parts: list[pa.RecordBatch], dim: int) -> Tree:
    t = pa.Table.from_batches(parts).combine_chunks()
    wants = [[(w["score"], w["id"]) for w in x or ()] for x in t.column("wants").to_pylist()]
    column = t.column("v").combine_chunks()
    return Tree(_matrix(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column, dim), t.column("parent").to_numpy().astype(np.int64),
                t.column("edge").to_numpy(), t.column("id").to_numpy(), t.column("label").to_numpy(), wants)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         anchors_per_tree: int = ANCHORS, rows_per_task: int = ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: (id, label, dim, v) of :func:`quantised`; ``is_anchor`` of its
    columns.  The window of a positive is ``low * positive <= 100 * score <=
    high * positive``, in percent.
    """
    rows = stage_table(rows)
    one = rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "dim", "v")).alias("r")).select("id", "r.*")
    sizes = one.groupBy("dim").agg(F.count("*").alias("anchors")).join(rows.groupBy("dim").agg(F.count("*").alias("rows")), "dim")
    sizes = stage_table(sizes.select("dim", F.ceil(F.col("anchors") / anchors_per_tree).cast("int").alias("blocks"),
                                     F.ceil(F.col("rows") / rows_per_task).cast("int").alias("parts")))
    blocks = one.join(sizes, "dim").select("dim", F.pmod(F.xxhash64("id", F.lit("block")), "blocks").cast("int").alias("a"), "id", "label", "v")
    trees = stage_table(plant(blocks))

    nothing = F.lit(None).cast("array<struct<score:long,id:long>>").alias("wants")
    found = _search(trees.select("*", nothing), rows, sizes, lambda tree: Positives(tree, positives))
    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    chosen = stage_table(found.withColumn("n", first).where(F.col("n") <= positives).select("anchor_id", "id", "score"))

    wants = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("wants"))
    found = _search(trees.join(wants, "id", "left"), rows, sizes, lambda tree: Negatives(tree, negatives, low, high))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
