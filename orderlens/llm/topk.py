"""Exact top-k inner products by a three-phase uniform threshold.

The coordinates are split into ``LISTS`` groups; a query's score of a vector is the sum of the
groups' partial scores, and each group is a list of (vector, partial score).

1. Gather: in a share of the blocks (``GATHER``), the best entries of each list, with their full scores.  The k-th best
   full score found for a query is its safe cutoff: the true k-th best can't be lower.  A share is enough for a
   cutoff near the true one, and the other blocks' products are made once, in the next phase.
2. Cut: a vector whose full score reaches the cutoff has a partial score of cutoff / LISTS or more in
   at least one list.  The cutoffs travel with the queries, and each block collects the entries that
   are sufficient in some list.
3. Resolve: only those get their full score, exactly; what reaches the cutoff is ranked.

A block returns k rows a query at most, so any number of ties or copies stays in the tasks.
Components become ``floor(256 * x)``; sums are exact: floating-point products as long as all of
them fit 53 bits, Python integers otherwise (cut to 64 bits in the result).

Cases: see ``blocks`` for vectors that take no part; with fewer candidates than k, all are returned;
an empty table gives an empty result; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.blocks import BLOCK, asked, best, block_count, dealt, streamed, valid_vectors
from orderlens.llm.common import settled, stored, workspace

SCALE, LISTS = 256, 4
#: one in so many blocks is gathered from
GATHER = 8
RESULT = "query_id bigint, vec_id bigint, score bigint"


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scaled integer components, in a type whose products and sums are exact."""
    a, b = np.floor(SCALE * a), np.floor(SCALE * b)
    if not len(a) or not len(b) or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2**53:
        return a, b
    return np.array([[int(x) for x in row] for row in a], object), np.array([[int(x) for x in row] for row in b], object)


def _lists(dim: int) -> list[slice]:
    edges = np.linspace(0, dim, min(LISTS, dim) + 1).astype(int)
    return [slice(i, j) for i, j in zip(edges, edges[1:])]


def _found(query_ids: list, vec_ids: list, scores: list) -> pa.RecordBatch:
    low, high = -(2**63), 2**63 - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(query_ids, pa.int64()),
            pa.array(vec_ids, pa.int64()),
            pa.array([min(max(int(s), low), high) for s in scores], pa.int64()),
        ],
        ["query_id", "vec_id", "score"],
    )


def _gather(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: full scores of the best entries of each list."""
    for _, ids, vectors, query_ids, queries, _ in streamed(batches, k):
        q, v = _exact(queries, vectors)
        partial = [q[:, s] @ v[:, s].T for s in _lists(q.shape[1])]
        out = ([], [], [])
        for i, query in enumerate(query_ids):
            own = np.flatnonzero(ids != query)
            top = np.unique(np.concatenate([own[best(-p[i, own], ids[own], k)] for p in partial])) if len(own) else own
            totals = sum(p[i, top] for p in partial)
            chosen = top[best(-totals, ids[top], k)] if len(top) else top
            out[0].extend([int(query)] * len(chosen))
            out[1].extend(ids[chosen].tolist())
            out[2].extend(sum(p[i, chosen] for p in partial).tolist() if len(chosen) else [])
        yield _found(*out)


def _resolve(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Phases 2 and 3: entries that are sufficient in some list, and their full scores."""
    for _, ids, vectors, query_ids, queries, cutoffs in streamed(batches, k):
        q, v = _exact(queries, vectors)
        lists = _lists(q.shape[1])
        enough = np.zeros((len(q), len(v)), bool)
        for s in lists:
            enough |= (len(lists) * (q[:, s] @ v[:, s].T) >= cutoffs[:, None]).astype(bool)
        enough &= ids[None, :] != query_ids[:, None]
        out = ([], [], [])
        for i, query in enumerate(query_ids):
            entries = np.flatnonzero(enough[i])
            totals = v[entries] @ q[i]
            reach = totals >= cutoffs[i]
            entries, totals = entries[reach], totals[reach]
            chosen = best(-totals, ids[entries], k) if len(entries) else entries
            out[0].extend([int(query)] * len(chosen))
            out[1].extend(ids[entries[chosen]].tolist())
            out[2].extend(totals[chosen].tolist())
        yield _found(*out)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best ``rows`` of each of ``queries``, both (id, vec), but its own."""
    blocks = block_count(rows.count(), block)
    queries = asked(queries, k)
    no_cutoff = queries.withColumn("cutoff", F.lit(None).cast("double"))
    gathered = stored(dealt(rows, no_cutoff, blocks, -(-blocks // GATHER)).mapInArrow(lambda b: _gather(b, k), RESULT), "topk-gathered")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    # doubles hold these cutoffs rounded down at worst: a lower cutoff is safe
    cutoffs = gathered.withColumn("place", place).where(F.col("place") == k)
    lowered = F.col("score").cast("double")
    lowered = F.when(F.abs(F.col("score")) < 2**53, lowered).otherwise(lowered - F.abs(lowered) * 1e-12)
    cutoffs = stored(cutoffs.select(F.col("query_id").alias("id"), lowered.alias("cutoff")), "topk-cutoffs")
    told = queries.join(cutoffs, "id", "left").select("id", "vec", F.coalesce("cutoff", F.lit(float("-inf"))).alias("cutoff"))
    resolved = dealt(rows, told, blocks).mapInArrow(lambda b: _resolve(b, k), RESULT)
    return resolved.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The rows whose id is divisible by ``every`` against all rows."""
    with workspace(embeddings.sparkSession):
        rows = stored(valid_vectors(embeddings), "topk-rows")
        return settled(top_k(rows, rows.where(F.col("id") % every == 0), k))
