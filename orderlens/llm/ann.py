"""Approximate nearest neighbours with a forest of hash prefixes.

Every block of rows is indexed by ``TREES`` sorted arrays of long hash strings: a bit of a string is
the side of a random hyperplane through the block's mean on which a vector lies.  A query descends in
each tree to the entries that share its longest prefix.  Then all trees ascend together, a
bit at a time, until the ranges of entries that share the prefix hold ``EFFORT`` times as many entries
as the block has rows (an entry counts in each tree).  The distinct entries found are
measured exactly, in double precision on the original vectors, and ranked.

The prefix is as long as the data allow: where many vectors crowd around a query it stays long.  No
list of entries is cut off: a range of equal strings is taken whole.  ``EFFORT`` sets the recall; the
test vectors are isotropic in 64 dimensions, where the tenth neighbour is nearly as far as the
median, so that a recall of 0.9 needs a large share of the rows.  Rows that crowd (the usual case)
need far less.  Every row is indexed; nothing is fitted but the mean.

Cases: zero vectors and those that ``blocks`` names take no part; with fewer candidates than k, all
are returned (a query that meets fewer entries ascends to the root); ties go to the smaller id; an empty table
gives an empty result; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.blocks import BLOCK, asked, best, block_count, dealt, streamed, valid_vectors
from orderlens.llm.common import settled, stored, workspace

TREES, BITS, EFFORT, SEED = 64, 32, 0.6, 17


class PrefixForest:
    """The sorted hash strings of a block's vectors."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.trees, self.bits = trees, bits
        self._planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], trees * bits))
        self._mean = vectors.mean(axis=0)
        self.n = len(vectors)
        codes = self.codes(vectors)
        self._order = np.argsort(codes, axis=0, kind="stable")
        self._sorted = np.take_along_axis(codes, self._order, axis=0)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(vectors, trees): each hash string as an integer, its first bit the highest."""
        codes = np.empty((len(vectors), self.trees), np.int64)
        for s in range(0, len(vectors), BLOCK):
            sides = ((vectors[s : s + BLOCK] - self._mean) @ self._planes > 0).reshape(-1, self.trees, self.bits)
            codes[s : s + BLOCK] = sides.astype(np.int64) @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))
        return codes

    def candidates(self, queries: np.ndarray, effort: float, least: np.ndarray) -> Iterator[np.ndarray]:
        """For each query the places of the entries found."""
        codes = self.codes(queries)
        want = np.maximum(effort * self.n, least)
        low = np.zeros((self.bits + 1, len(queries), self.trees), np.int64)
        high = np.full_like(low, self.n)
        for length in range(1, self.bits + 1):
            rest = self.bits - length
            start = (codes >> rest) << rest
            for t in range(self.trees):
                low[length, :, t] = np.searchsorted(self._sorted[:, t], start[:, t])
                high[length, :, t] = np.searchsorted(self._sorted[:, t], start[:, t] + (1 << rest))
        held = (high - low).sum(axis=2) >= want
        # the longest prefix, the same in all trees, that holds enough; the root holds every row in each
        length = self.bits - np.argmax(held[::-1], axis=0)
        length[~held.any(axis=0)] = 0
        for i, n in enumerate(length):
            yield np.unique(np.concatenate([self._order[low[n, i, t] : high[n, i, t], t] for t in range(self.trees)]))


def _nearest(batches: Iterator[pa.RecordBatch], k: int, effort: float) -> Iterator[pa.RecordBatch]:
    forest = None
    for new, ids, vectors, query_ids, queries, _ in streamed(batches, k):
        if new or forest is None:
            forest = PrefixForest(vectors)
        out = ([], [], [])
        # more entries than k, as the rows of the query's own id may be among them; times the trees that count each
        held, times = np.unique(ids, return_counts=True)
        place = np.minimum(np.searchsorted(held, query_ids), len(held) - 1)
        least = (k + np.where(held[place] == query_ids, times[place], 1)) * forest.trees
        for query, vector, places in zip(query_ids, queries, forest.candidates(queries, effort, least)):
            places = places[ids[places] != query]
            difference = vectors[places] - vector
            distance = np.sqrt(np.einsum("ij,ij->i", difference, difference))
            chosen = best(distance, ids[places], k) if len(places) else places
            out[0].extend([int(query)] * len(chosen))
            out[1].extend(ids[places[chosen]].tolist())
            out[2].extend(distance[chosen].tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"]
        )


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, effort: float = EFFORT, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest ``rows`` found for each of ``queries``, both (id, vec)."""
    blocks = block_count(rows.count(), block)
    no_cutoff = asked(queries, k).withColumn("cutoff", F.lit(None).cast("double"))
    found = dealt(rows, no_cutoff, blocks).mapInArrow(lambda b: _nearest(b, k, effort), "query_id bigint, vec_id bigint, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).cast("int")
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame, every: int = 100, k: int = 10, effort: float = EFFORT) -> DataFrame:
    """The rows whose id is divisible by ``every`` against all rows."""
    with workspace(embeddings.sparkSession):
        rows = stored(valid_vectors(embeddings, nonzero=True), "ann-rows")
        return settled(nearest(rows, rows.where(F.col("id") % every == 0), k, effort))
