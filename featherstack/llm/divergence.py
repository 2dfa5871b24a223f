"""Source divergence audit: how far each source's vocabulary lies from that of
the other sources of its language, by three-dimensional cube partitioning.

A group is a (lang, source) pair.  Terms that enough documents of a language
hold are kept, and every group gives each kept term a smoothed share in whole
parts of SCALE: ``p = 1 + floor(SCALE * (count + ALPHA) / (N + ALPHA * V))``.

The divergence of two groups is the sum of ``|p - q|`` over all V kept terms.
For each language the work is a cube: groups are dealt into blocks of about
GROUP_BLOCK by hash, terms into blocks of about TERM_BLOCK, and a task owns
cells (group block, group block, term block).  A slice of counts (one group
block by one term block) is replicated to the cells that hold its group block
on either side; a cell returns partial divergences of its pairs of groups, and
these are summed along the term axis.  Only counts above 0 travel: terms that
neither group holds add ``|p0 - q0|`` each, which is known from the groups'
totals, so a cell returns what its terms add beyond that, and the cell of term
block 0 adds the V-fold base once.

Counts are combined in the task that reads the texts and again before the
shuffle, so a source with a third of all rows is as many rows as it has terms.
All arithmetic is in integers; a product that could pass 63 bits is taken in
Python's own integers or decimals.

Cases: NULL text, lang and source are ''; every row is a document, rows that
share an id or a text included; a text without terms adds none, but its group
is in the result; a language without kept terms has V = 0 and divergences of
0; very long texts are whole; ties in value go by the item's UTF-8 order; an
empty table gives no rows; other columns of the input, whatever their names,
are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, map_batches, stage_table

SCALE = 1_000_000_000
ALPHA = 5
MIN_DOCS = 30
GROUP_BLOCK = 64
TERM_BLOCK = 8192
ENTRIES_KEPT = 500_000  # (lang, source, term) counts that a task combines before it hands them on
#: A-Z lower-cased; ASCII that is no letter is a blank; other bytes are kept.
TERM_BYTES = bytes(c if 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def count_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in
    each group; a row with a NULL term stands for the group itself."""
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: defaultdict[tuple, Counter] = defaultdict(Counter)
        held: defaultdict[tuple, Counter] = defaultdict(Counter)
        for batch in batches:
            for text, *group in zip(batch.column("text"), batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True):
                words = text.as_py().translate(TERM_BYTES).split()
                n[tuple(group)].update(words)
                held[tuple(group)].update(set(words))
            if sum(map(len, n.values())) >= ENTRIES_KEPT:
                yield handed(n, held)
                n.clear()
                held.clear()
        if n:
            yield handed(n, held)

    def handed(n: dict[tuple, Counter], held: dict[tuple, Counter]) -> pa.RecordBatch:
        size = [len(c) + 1 for c in n.values()]
        columns = [pa.array(np.repeat(np.array([g[i] for g in n], object), size), pa.string()) for i in (0, 1)]
        terms = [x for c in n.values() for x in (None, *c)]
        counts = [np.fromiter((x for g, c in n.items() for x in (0, *(t[g][w] for w in c))), np.int64, len(terms)) for t in (n, held)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(terms, pa.binary()).cast(pa.string()), *map(pa.array, counts)],
                                          names=["lang", "source", "term", "n", "docs"])
    found = map_batches(rows, run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, kept: str):
    """``1 + floor(SCALE * (count + ALPHA) / (total + ALPHA * kept))`` of three long columns, exactly."""
    return F.expr(f"1 + (CAST({count} + {ALPHA} AS DECIMAL(20, 0)) * {SCALE}BD) DIV CAST({total} + {ALPHA} * {kept} AS DECIMAL(20, 0))")


def shares(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The same in numpy: ``below`` is N + ALPHA * V of each count."""
    if len(counts) and counts.max() > (2**63 - 1) // SCALE - ALPHA:
        counts = counts.astype(object)
    return (1 + (counts + ALPHA) * SCALE // below).astype(np.int64)


def _cells(entries: DataFrame, totals: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, i, j, t, side, source, term, n): every slice at each cell that needs it.

    A group's row (NULL term, its N) goes to all its cells, the counts to those
    of their term block.  ``side`` tells the group block that the row is of.
    """
    rows = entries.select("lang", "source", "term", "n").unionByName(totals.select("lang", "source", F.lit(None).cast("string").alias("term"), "n"))
    rows = rows.join(sizes, "lang").withColumn("b", F.pmod(F.xxhash64("source"), "group_blocks").cast("int"))
    one = F.array(F.pmod(F.xxhash64("term"), "term_blocks").cast("int"))
    terms = F.when(F.col("term").isNull(), F.sequence(F.lit(0), F.col("term_blocks").cast("int") - 1)).otherwise(one)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks").cast("int") - 1))).withColumn("t", F.explode(terms))
    return rows.select("lang", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), "t", F.col("b").alias("side"),
                       "source", "term", "n", "v")


def cell_divergences(cell: pa.RecordBatch) -> tuple[list[str], list[str], np.ndarray]:
    """(a, b, partial) for each pair of groups of a cell."""
    i, j, t, v = (cell.column(c)[0].as_py() for c in ("i", "j", "t", "v"))
    terms = cell.column("term").dictionary_encode()
    known = terms.is_valid().to_numpy(zero_copy_only=False)
    sources = cell.column("source").to_numpy(zero_copy_only=False)
    side, n = cell.column("side").to_numpy(), cell.column("n").to_numpy()
    heads = np.flatnonzero(~known)
    order = heads[np.argsort(side[heads], kind="stable")]  # the groups of block i, then those of block j
    at = {s: k for k, s in enumerate(sources[order])}
    below = n[order] + ALPHA * v
    zero = shares(np.zeros(len(order), np.int64), below) if v else np.zeros(len(order), np.int64)
    p = np.repeat(zero[:, None], len(terms.dictionary), axis=1)
    rows = np.fromiter(map(at.__getitem__, sources[known]), np.int64, int(known.sum()))
    columns = terms.indices.filter(pa.array(known)).to_numpy(zero_copy_only=False).astype(np.int64)
    p[rows, columns] = shares(n[known], below[rows])
    first = int((side[order] == i).sum())
    others = range(first, len(order)) if i != j else range(len(order))
    a, b, partial = [], [], []
    for x in range(first):
        against = np.array([y for y in others if i != j or y > x], dtype=np.int64)
        base = np.abs(zero[x] - zero[against])
        beyond = np.abs(p[x] - p[against]).sum(axis=1) - base * p.shape[1]
        a += [order[x]] * len(against)
        b += order[against].tolist()
        partial.append(beyond + base * v if t == 0 else beyond)
    return sources[a].tolist(), sources[b].tolist(), np.concatenate(partial) if partial else np.zeros(0, np.int64)


def _pairs(cells: DataFrame) -> DataFrame:
    """(lang, a, b, value): divergences, each pair of groups once, summed along the term axis."""
    rows = cells.withColumn("cell", F.xxhash64("lang", "i", "j", "t"))
    rows = rows.repartition("lang", "i", "j", "t").sortWithinPartitions("cell", "lang", "i", "j", "t", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["cell", "i", "j", "t"]):
            a, b, value = cell_divergences(group)
            if len(value):
                yield pa.RecordBatch.from_arrays([pa.array([group.column("lang")[0].as_py()] * len(value)), pa.array(a), pa.array(b), pa.array(value)],
                                                 names=["lang", "a", "b", "value"])
    return map_batches(rows, run, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
          top_terms: int = 50, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: the divergence from every other source of the language, all
    ranks.  Part ``term``: the kept terms that the group holds and uses more
    than its language does, by ``p - q``, the first ``top_terms``.
    """
    counted = stage_table(count_terms(docs, text_col, lang_col, source_col))
    kept = counted.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = kept.where(F.col("docs") >= min_docs).drop("docs")
    entries = stage_table(counted.where("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]))
    used = entries.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    totals = counted.where("term IS NULL").select("lang", "source").join(used, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("n", F.lit(0)).alias("n"))
    totals = stage_table(totals)
    terms = entries.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    langs = totals.groupBy("lang").agg(F.count("*").alias("sources")).join(terms, "lang", "left").select(
        "lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        F.ceil(F.col("sources") / group_block).alias("group_blocks"),
        F.greatest(F.lit(1), F.ceil(F.coalesce("v", F.lit(0)) / term_block)).alias("term_blocks"))
    langs = stage_table(langs)

    pairs = _pairs(_cells(entries, totals, langs.select("lang", "v", "group_blocks", "term_blocks")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    rows = entries.join(totals.select("lang", "source", F.col("n").alias("total")), ["lang", "source"]).join(langs.select("lang", "v", "lang_total"), "lang")
    value = share("n", "total", "v") - share("lang_n", "lang_total", "v")
    rows = rows.where("n > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = rows.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", rank).unionByName(best)
