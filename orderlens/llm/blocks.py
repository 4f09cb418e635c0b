"""Vectors in blocks: a stated query set against all rows, without pairs of rows in a shuffle.

Rows are dealt to blocks of a bounded size by a hash of their id and vector, so equal vectors of many ids and
many vectors of one id spread over all blocks.  Every block gets all queries after its own rows; a task holds one block at a time and
streams the queries past it.  The rows are shuffled once, the queries once for each block; blocks grow with the table
until one fills a task's memory (``block_count``).

Vectors take part if they have an id and at least one component and all components are finite numbers.
Vectors of different lengths never meet.  Rows that repeat an id are candidates of their own, or queries
whose results are ranked together.  Of rows that repeat id and vector, a task holds k at most: no
ranking of k rows has a place for more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rows of a block, and queries that are handled at once with so many
BLOCK, CHUNK = 4096, 512
#: blocks up to which they keep that size; beyond, blocks grow, up to LARGEST rows, before there are more of them
FEW, LARGEST = 64, 65_536


def takes_part(id_col: str = "vec_id", vec_col: str = "embedding", nonzero: bool = False) -> Column:
    """Whether a row takes part; never null."""
    vec = F.col(vec_col)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    valid = F.col(id_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, finite)
    return F.coalesce(valid & F.exists(vec, lambda x: x != 0) if nonzero else valid, F.lit(False))


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", nonzero: bool = False) -> DataFrame:
    """(id, vec) of the rows that take part."""
    rows = df.where(takes_part(id_col, vec_col, nonzero))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))


def block_count(rows: int, block: int = BLOCK) -> int:
    """Blocks for so many rows.  Every block gets every query, so a large table has large blocks rather than many."""
    blocks = max(1, -(-rows // block))
    return blocks if blocks <= FEW else max(FEW, -(-rows // max(LARGEST, block)))


def asked(queries: DataFrame, k: int) -> DataFrame:
    """``queries`` (id, vec), of equal ones ``k`` at most: they go to every block."""
    copies = F.array_repeat(F.lit(1), F.least("count", F.lit(k)).cast("int"))
    return queries.groupBy("id", "vec").count().select("id", "vec", F.explode(copies)).select("id", "vec")


def dealt(rows: DataFrame, queries: DataFrame, blocks: int, first: int | None = None) -> DataFrame:
    """Rows (id, vec) and queries (id, vec, cutoff) by block, the rows of a block before its queries; of the ``first`` blocks only, if said."""
    own = F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int")
    if first is not None:
        rows = rows.where(own < first)
    every = F.explode(F.sequence(F.lit(0), F.lit((first or blocks) - 1)))
    columns = lambda block, query, cutoff: [
        block.alias("block"), F.size("vec").alias("dim"), F.lit(query).alias("query"), "id", "vec", cutoff.alias("cutoff")
    ]
    both = rows.select(*columns(own, False, F.lit(None).cast("double"))).union(queries.select(*columns(every, True, F.col("cutoff"))))
    # a count of its own: what a block costs is work, not bytes
    return both.repartition(2 * blocks, "block").sortWithinPartitions("block", "dim", "query", "id", "vec")


def _pieces(batches: Iterator[pa.RecordBatch], copies: int) -> Iterator[tuple[tuple, np.ndarray, np.ndarray, np.ndarray]]:
    """((block, dim, query), ids, vectors, cutoffs) of consecutive rows, equal ones ``copies`` times at most."""
    last, repeats = None, 0
    for batch in batches:
        block, dim, query, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        cutoff = batch.column(5).to_numpy(zero_copy_only=False).astype(float)
        change = np.flatnonzero((block[1:] != block[:-1]) | (dim[1:] != dim[:-1]) | (query[1:] != query[:-1])) + 1
        edges = [0, *change.tolist(), len(ids)] if len(ids) else [0]
        for i, j in zip(edges, edges[1:]):
            key = (int(block[i]), int(dim[i]), bool(query[i]))
            vectors = batch.column(4)[i:j].flatten().to_numpy().reshape(-1, key[1])
            part = ids[i:j]
            again = np.concatenate(([last is not None and last[:2] == (key, part[0]) and np.array_equal(last[2], vectors[0])], part[1:] == part[:-1]))
            at = np.flatnonzero(again[1:]) + 1
            again[at] = (vectors[at] == vectors[at - 1]).all(axis=1)
            # how many equal rows have come before each
            places = np.arange(len(part))
            before = places - np.maximum.accumulate(np.where(again, -1 - repeats, places))
            keep = before < copies
            last, repeats = (key, part[-1], vectors[-1].copy()), int(before[-1])
            yield key, part[keep], vectors[keep], cutoff[i:j][keep]


def streamed(batches: Iterator[pa.RecordBatch], copies: int) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(whether the block is new, its ids, its vectors, query ids, query vectors, cutoffs)."""
    held: tuple | None = None
    ids: list[np.ndarray] = []
    vectors: list[np.ndarray] = []
    new = False
    for (block, dim, query), part_ids, part_vectors, cutoffs in _pieces(batches, copies):
        if not query:
            if held != (block, dim):
                held, ids, vectors = (block, dim), [], []
            ids.append(part_ids)
            vectors.append(part_vectors)
            new = True
        elif held == (block, dim):
            if len(ids) > 1:
                ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
            chunk = max(1, min(CHUNK, CHUNK * BLOCK // len(ids[0])))
            for s in range(0, len(part_ids), chunk):
                yield new, ids[0], vectors[0], part_ids[s : s + chunk], part_vectors[s : s + chunk], cutoffs[s : s + chunk]
                new = False


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest scores, ties to the smaller id; all that tie with the k-th are ranked."""
    if len(scores) > k:
        limit = np.partition(scores, k - 1)[k - 1]
        near = np.flatnonzero(scores <= limit)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], scores[near]))[:k]]
